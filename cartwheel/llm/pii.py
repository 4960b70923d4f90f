"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, scheme marks,
digits and identifier cues.  From each anchor a deterministic parser expands
left and right to the boundaries of an email, a numeric cluster (addresses of
machines, card and phone numbers), a URL, an account, a secret or a postal
address, and validates it.  Every document is handled where it is read; there
is no shuffle.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import ship, text_column, tidy

#: Kinds in the order of the output; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "iban", "account", "secret", "address")
BASE = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMERIC = frozenset("0123456789. ()+-")
_CLUSTER = re.compile(r"[0-9. ()+-]+")
#: A run of digits can only match from its first one, so it is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SCHEME = re.compile(r"(?:https?|ftp|ssh|git|file)\Z", re.I)
_URL_REST = re.compile(r"[^\s<>\"'`{}|\\^]+")
_IBAN = re.compile(r"[\s:#]{0,4}([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:\s{0,2}(?:number|nummer|numéro|número|no\.?|nr\.?|id))?[\s:#=]{1,4}([0-9](?:[ -]?[0-9]){5,16})(?![0-9A-Za-z])", re.I)
_ACCESS_KEY = re.compile(r"[A-Z0-9]{16}(?![A-Za-z0-9])")
#: A secret is as long as it is.
_ASSIGNED = re.compile(r"[\"']?\s{0,2}[=:]\s{0,2}[\"']?([A-Za-z0-9+/_.~-]{8,}+)")
_BEARER = re.compile(r"\s{1,2}([A-Za-z0-9+/_.~-]{8,}+)")
_HOUSE = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,5}[A-Za-z]? (?:[^\W\d_][\w.'-]{0,30} ){1,4}\Z")
#: A house number behind the street's name, and what may stand before a cue
#: that is the end of a name.
_NUMBER = re.compile(r"\s{1,2}[0-9]{1,5}[A-Za-z]?(?![\w])")
_NAME_PART = re.compile(r"[^\W\d_][\w'-]{0,40}\Z")
_NAME = re.compile(r" (?:[^\W\d_][\w.'-]{0,30} ){1,5}[0-9]{1,5}[A-Za-z]?(?![\w])")

#: Cues are found in any mix of upper and lower case.
_ACCOUNT_CUES = ("account", "acct", "konto", "kontonummer", "compte", "cuenta")
_SECRET_CUES = ("password", "passwd", "passwort", "passphrase", "token", "secret", "api_key", "api-key", "api key", "apikey", "access_key", "private_key")
#: After a house number and a name; at the end of a name before the number;
#: before a name and the number.
_STREET_CUES = ("street", "avenue", "road", "boulevard", "lane", "drive", "court", "highway", "square", "place", "st.", "ave.", "rd.", "blvd")
_ENDING_CUES = ("strasse", "straße", "str.", "platz", "allee")
_LEADING_CUES = ("rue", "calle", "avenida", "paseo")


@functools.lru_cache(maxsize=1)
def _automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for word in "0123456789":
        a.add_word(word, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("://", ("scheme", 3))
    a.add_word("iban", ("iban", 4))
    a.add_word("akia", ("key", 4))
    a.add_word("bearer", ("bearer", 6))
    for kind, cues in (("account", _ACCOUNT_CUES), ("secret", _SECRET_CUES), ("street", _STREET_CUES), ("ending", _ENDING_CUES),
                       ("leading", _LEADING_CUES)):
        for cue in cues:
            a.add_word(cue, (kind, len(cue)))
    a.make_automaton()
    return a


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _iban_valid(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by kind as in KINDS
    and then start.  The base kinds are exactly the leftmost non-overlapping
    matches of their patterns, less those that fail their check."""
    found = {k: [] for k in KINDS}
    email_end = cluster_end = url_end = 0
    # A-Z only, so that positions stay
    for end, (kind, size) in _automaton().iter(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")):
        at = end - size + 1
        after = end + 1
        if kind == "digit":
            if at < cluster_end:
                continue
            start = at
            while start > 0 and text[start - 1] in _NUMERIC:
                start -= 1
            cluster_end = _CLUSTER.match(text, start).end()
            if cluster_end - start < 3:
                continue
            for m in _IP.finditer(text, start, cluster_end):
                parts = [p.lstrip("0") for p in m[0].split(".")]
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                    found["ip"].append(m.span())
            for m in _CARD.finditer(text, start, cluster_end):
                if m.end() - m.start() >= 16 and 16 <= len(d := _only_digits(m[0])) <= 19 and _luhn(d):
                    found["card"].append(m.span())
            for m in _PHONE.finditer(text, start, cluster_end):
                if 8 <= len(_only_digits(m[0])) <= 15:
                    found["phone"].append(m.span())
        elif kind == "at":
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, after)):
                found["email"].append((start, m.end()))
                email_end = m.end()
        elif kind == "scheme":
            if at < url_end or not (m := _SCHEME.search(text[max(0, at - 5):at])):
                continue  # a scheme inside a URL is part of it
            if rest := _URL_REST.match(text, after):
                stop = after + len(rest[0].rstrip(".,;:!?)]"))
                if stop > after:
                    found["url"].append((at - len(m[0]), stop))
                    url_end = stop
        elif kind == "iban":
            number = m[1] if (m := _IBAN.match(text, after)) else ""
            while number and not _iban_valid(number):  # words that follow go
                number = number.rpartition(" ")[0]
            if len(number.replace(" ", "")) >= 15:
                found["iban"].append((m.start(1), m.start(1) + len(number)))
        elif kind == "account":
            if m := _ACCOUNT.match(text, after):
                found["account"].append(m.span(1))
        elif kind == "key":
            if text[at:after] == "AKIA" and (at == 0 or not text[at - 1].isalnum()) and (m := _ACCESS_KEY.match(text, after)):
                found["secret"].append((at, m.end()))
        elif kind in ("secret", "bearer"):
            m = _ASSIGNED.match(text, after) or kind == "bearer" and (at == 0 or not text[at - 1].isalnum()) and _BEARER.match(text, after)
            if m and any("0" <= c <= "9" for c in m[1]):
                found["secret"].append(m.span(1))
        elif kind == "ending":
            name = _NAME_PART.search(text, max(0, at - 42), at)
            if (m := _NUMBER.match(text, after)) and (name or text[at].isupper()):
                found["address"].append((name.start() if name else at, m.end()))
        elif kind == "leading":
            if (at == 0 or not text[at - 1].isalnum()) and (m := _NAME.match(text, after)):
                found["address"].append((at, m.end()))
        elif (after == len(text) or not text[after].isalnum()) and (m := _HOUSE.search(text[max(0, at - 160):at])):
            found["address"].append((at - len(m[0]), after))
    return [(k, s, e) for k in KINDS for s, e in sorted(set(found[k]))]


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or union of overlapping spans, replaced by
    the upper-case kind of its first one in brackets."""
    out, at = [], 0
    merged: list[list] = []
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([k, s, e])
    for k, s, e in merged:
        out += [text[at:s], f"[{k.upper()}]"]
        at = e
    return "".join(out) + text[at:]


def _find(redact):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    @tidy
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            spans, texts = [], []
            for t in batch.column(at):
                t = t.as_py()
                found = find_spans(t) if t else []
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                texts.append(redact_text(t, found) if found and redact else t)
            columns = list(batch.columns)
            if redact:
                columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], names=[*batch.schema.names, "pii_spans"])
    return run


def find_pii(docs: DataFrame, redact: bool = False) -> DataFrame:
    """The columns of ``docs`` and pii_spans (kind, start, end in code points
    of the given text); with ``redact`` the text has the spans replaced.

    Null and empty texts have no spans and stay as they are; whole texts of
    any length are read; repeated rows and null ids pass through; an empty
    table stays empty.  A column named pii_spans is replaced.
    """
    ship(docs.sparkSession)
    docs = docs.drop("pii_spans")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_find(redact), f"{fields}, pii_spans array<struct<kind:string,start:long,end:long>>")


def op6_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text_column().alias("text"))
    base = ", ".join(f"'{k}'" for k in BASE)

    def listed(spans):
        return f"concat_ws(',', transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)))"

    counts = [F.expr(f"size(filter(pii_spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in BASE]
    return find_pii(docs).select(
        "doc_id", *counts,
        F.sha2(F.expr(listed(f"filter(pii_spans, s -> s.kind in ({base}))")).cast("binary"), 256).alias("base_sha256"),
        F.expr(listed("pii_spans")).alias("spans"))
