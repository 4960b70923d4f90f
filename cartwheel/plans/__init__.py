from cartwheel.plans.catalog import QUERIES  # noqa: F401
from cartwheel.plans.oracle import ORACLE_SQL  # noqa: F401
