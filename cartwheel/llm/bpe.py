"""Byte-level BPE encoding and decoding through a global distinct-word shuffle.

Pre-tokens with positions would be hundreds of bytes of shuffle per word if
every occurrence were a row, so they are exploded per *block* (the documents
a task reads, up to ``BLOCK_CHARS``): one row for each distinct pre-token of
the block, and one compact code sequence per document that keeps the
positions.  The words are dealt by word and sorted, so every distinct word is
encoded exactly once in the whole job; the ids go back to the block, which
reassembles each document by position.

A pre-token that is itself a vocabulary entry has its one id from the rank
table and isn't shuffled.  Any other word sends one row per block however
often it occurs, so no key can grow hot.  Block ids are hashes of the block's
content: a recomputed task yields the same ids.
"""

from __future__ import annotations

import array
import base64
import functools
import hashlib
import heapq
import itertools
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import give_back, ship, text_column, tidy

#: Characters of a block, and encoded words buffered before they are sent on.
BLOCK_CHARS, BUFFER_WORDS = 32_000_000, 400_000
#: A run of other characters with one space before it, or white space.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CHUNKS = f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
#: Codes below this are vocabulary ids; above it, positions in the block's word list.
DIRECT = 1 << 20


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


@functools.lru_cache(maxsize=4)
def _pattern(text: str):
    import regex
    return regex.compile(text)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of least rank, leftmost first,
    is merged until no pair is in the table."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 96:
        return _merge_long(piece, ranks)
    get, none = ranks.get, 1 << 60
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a long pre-token, with a heap over linked parts."""
    n = len(piece)
    end = list(range(1, n + 1))
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def push(i):
        j = after[i]
        if j < n:
            r = ranks.get(piece[i:end[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        push(i)
    alive = [True] * n
    while heap:
        _, i, e = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != e:
            continue
        j = after[i]
        alive[j] = False
        end[i], after[i] = e, after[j]
        if after[i] < n:
            before[after[i]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = after[i]
    return out


class _Index(dict):
    """Number of every chunk of a block, in order of first sight."""

    def __missing__(self, chunk):
        self[chunk] = n = len(self)
        return n


def _expand(chunks, pattern, rank_path):
    """Pre-tokens of the distinct chunks: words to encode, then per chunk the
    start and number of its codes in a flat array."""
    find, ranks = _pattern(pattern).findall, load_ranks(rank_path)
    direct = {k.decode(): v for k, v in ranks.items() if _is_utf8(k)}
    number, sizes, flat = {}, array.array("q"), array.array("q")
    for chunk in chunks:
        tokens = (chunk,) if chunk.isascii() and (chunk[1:] if chunk[0] == " " else chunk).isalpha() else find(chunk)
        sizes.append(len(tokens))
        for t in tokens:
            code = direct.get(t)
            flat.append(DIRECT + number.setdefault(t, len(number)) if code is None else code)
    sizes = np.array(sizes, dtype=np.int64)
    return list(number), np.cumsum(sizes) - sizes, sizes, np.frombuffer(flat, dtype=np.int64)


def _blocks(batches, chunk_pattern, positions, block_chars):
    """(block id, distinct chunks, documents) of the rows of one task, cut
    only by the number of characters seen.  With ``positions`` the documents
    are (doc_id, numbers of the chunks); else they are left out."""
    find = re.compile(chunk_pattern).findall

    def start():
        return _Index() if positions else {}, [], hashlib.blake2b(digest_size=8), 0

    seen, docs, digest, chars = start()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            doc_id, text = ids[i].as_py(), texts[i].as_py()
            if positions:
                docs.append((doc_id, np.array([seen[c] for c in find(text)], dtype=np.uint32)))
            else:
                seen.update(zip(find(text), itertools.repeat(None)))
            digest.update(b"%d\0" % (doc_id or 0) + text.encode() + b"\0")
            chars += len(text)
            if chars >= block_chars:
                yield int.from_bytes(digest.digest(), "little", signed=True), seen, docs
                seen, docs, digest, chars = start()
    if chars or docs:
        yield int.from_bytes(digest.digest(), "little", signed=True), seen, docs


def _is_utf8(b: bytes) -> bool:
    try:
        b.decode()
        return True
    except UnicodeDecodeError:
        return False


def _block_words(pattern, chunk_pattern, rank_path, block_chars):
    @tidy
    def run(batches):
        for block, chunks, _ in _blocks(batches, chunk_pattern, False, block_chars):
            words = _expand(chunks, pattern, rank_path)[0]
            for at in range(0, len(words), 100_000):
                part = words[at:at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.string()), pa.array(np.full(len(part), block)),
                     pa.array(np.arange(at, at + len(part), dtype=np.int32))], names=["word", "block", "k"])
    return run


def _block_codes(pattern, chunk_pattern, rank_path, block_chars):
    @tidy
    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for block, chunks, docs in _blocks(batches, chunk_pattern, True, block_chars):
            words, starts, sizes, flat = _expand(chunks, pattern, rank_path)
            for at in range(0, len(docs), 2000):
                part = docs[at:at + 2000]
                codes = [_gather(starts, sizes, flat, c) for _, c in part]
                planes = [pack((c & 0xFFFF).astype("<u2").tobytes() + (c >> 16).astype("<u2").tobytes()) for c in codes]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), block)), pa.array(np.full(len(part), len(words), dtype=np.int32)),
                     pa.array([d for d, _ in part], pa.int64()), pa.array(planes, pa.binary())],
                    names=["block", "n_words", "doc_id", "codes"])
    return run


def _encode_words(rank_path):
    """Words come sorted: each is encoded when it first appears.  The ids are
    sent back packed per block."""
    @tidy
    def run(batches):
        ranks = load_ranks(rank_path)
        pack = zstandard.ZstdCompressor(level=3).compress

        def send(held):
            rows = []
            for block, (ks, ids) in held.items():
                order = np.argsort(ks, kind="stable")
                k = np.array(ks, dtype=np.uint32)[order]
                step = np.diff(k, prepend=k[:1] * 0).astype("<u4")
                size = np.array([len(ids[o]) for o in order], dtype="<u4")
                flat = np.fromiter((x for o in order for x in ids[o]), dtype="<u4", count=int(size.sum()))
                rows.append((block, len(k), pack(step.tobytes() + size.tobytes() + flat.tobytes())))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                               pa.array([r[2] for r in rows], pa.binary())], names=["block", "n", "ids"])

        held, count, last, ids = {}, 0, None, None
        for batch in batches:
            for word, block, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if word != last:
                    last, ids = word, merge(word.encode(), ranks)
                own = held.get(block)
                if own is None:
                    own = held[block] = ([], [])
                own[0].append(k)
                own[1].append(ids)
                count += 1
            if count >= BUFFER_WORDS:
                yield send(held)
                held, count = {}, 0
        if held:
            yield send(held)
    return run


def _gather(starts, sizes, flat, codes):
    size = sizes[codes]
    total = int(size.sum())
    first = np.repeat(starts[codes] - (np.cumsum(size) - size), size)
    return flat[first + np.arange(total)]


def _reassemble(rank_path, decoded):
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        back = _decoder(rank_path) if decoded else None
        n_words = max(docs.column("n_words").to_pylist(), default=0)
        sizes = np.concatenate((np.ones(DIRECT, dtype=np.int64), np.zeros(n_words, dtype=np.int64)))
        starts = np.arange(DIRECT + n_words, dtype=np.int64)
        flat, at = [np.arange(DIRECT, dtype=np.uint32)], DIRECT
        for n, blob in zip(words.column("n").to_pylist(), words.column("ids").to_pylist()):
            a = np.frombuffer(unpack(blob), dtype="<u4")
            k = DIRECT + np.cumsum(a[:n].astype(np.int64))
            size = a[n:2 * n].astype(np.int64)
            sizes[k] = size
            starts[k] = at + np.cumsum(size) - size
            flat.append(a[2 * n:])
            at += int(size.sum())
        if n_words and not sizes.all():
            raise RuntimeError("a block's words changed between two reads: the input must be a table, not a random expression")
        flat = np.concatenate(flat)
        names = ["doc_id", "ids", "decoded"] if decoded else ["doc_id", "ids"]
        parts = []
        for batch in docs.select(["doc_id", "codes"]).to_batches(max_chunksize=200):  # small batches out
            out = []
            for blob in batch.column("codes"):
                a = np.frombuffer(unpack(blob.as_buffer()), dtype="<u2").astype(np.int64)
                codes = a[:len(a) // 2] + (a[len(a) // 2:] << 16)
                out.append(_gather(starts, sizes, flat, codes).astype("<u4"))
            columns = [batch.column("doc_id"), pa.array([x.tobytes() for x in out], pa.binary())]
            if decoded:
                columns.append(pa.array([back(x) for x in out], pa.binary()))
            parts.append(pa.RecordBatch.from_arrays(columns, names=names))
        kinds = [pa.int64(), pa.binary(), pa.binary()]
        give_back()
        return pa.Table.from_batches(parts, schema=pa.schema(list(zip(names, kinds))))
    return run


def _decoder(rank_path):
    """Bytes of an array of ids, gathered from the token-byte table."""
    by_id = sorted((v, k) for k, v in load_ranks(rank_path).items())
    top = by_id[-1][0] + 1 if by_id else 0
    sizes, starts = np.zeros(top, dtype=np.int64), np.zeros(top, dtype=np.int64)
    ids = np.array([v for v, _ in by_id], dtype=np.int64)
    sizes[ids] = [len(k) for _, k in by_id]
    starts[ids] = np.cumsum(sizes[ids]) - sizes[ids]
    flat = np.frombuffer(b"".join(k for _, k in by_id), dtype=np.uint8)
    return lambda x: _gather(starts, sizes, flat, x).tobytes()


def encode(docs: DataFrame, rank_path: str, pattern: str, chunk_pattern: str = CHUNKS, decoded: bool = False,
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Token ids of every whole text: doc_id, ids (binary, little-endian
    unsigned 32-bit, in text order).  One row per input row.  ``decoded``
    adds the bytes that the ids stand for, decoded by the same tasks.
    ``chunk_pattern`` cuts a text into chunks cheaply, only where ``pattern``
    always starts a new match; the default suits patterns that cut before
    each single space.  A task holds ``block_chars`` characters at a time:
    smaller blocks need less memory and send common words more often.

    Null text is read as empty and has no ids; a null doc_id is kept; repeated
    rows are encoded alike; a text or a word of any length is encoded whole;
    an empty table gives no rows; other columns are ignored.  ``docs`` is read
    twice and must give the same rows in the same tasks both times, as any
    table does; a difference is detected and raised.
    """
    ship(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    words = (base.mapInArrow(_block_words(pattern, chunk_pattern, rank_path, block_chars), "word string, block long, k int")
             .repartition("word").sortWithinPartitions("word")
             .mapInArrow(_encode_words(rank_path), "block long, n int, ids binary"))
    codes = base.mapInArrow(_block_codes(pattern, chunk_pattern, rank_path, block_chars), "block long, n_words int, doc_id long, codes binary")
    return (codes.groupBy("block").cogroup(words.groupBy("block"))
            .applyInArrow(_reassemble(rank_path, decoded), "doc_id long, ids binary" + ", decoded binary" * decoded))


def decode(encoded: DataFrame, rank_path: str) -> DataFrame:
    """Adds ``decoded`` (binary) to a table with ``ids``: every id's bytes
    from the token-byte table, a bounded table that each task holds, joined
    in order.  Null ids decode to null, empty ones to no bytes."""
    ship(encoded.sparkSession)

    def run(batches):
        back = _decoder(rank_path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            out = [back(np.frombuffer(x.as_buffer(), dtype="<u4")) if x.is_valid else None for x in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{columns}, decoded binary")


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    rank_path, pattern = public_vocabulary()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs, rank_path, pattern, decoded=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
