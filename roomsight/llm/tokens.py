"""Token ids in files: length-limited canonical Huffman code from global counts.

``write`` makes three Parquet folders under a path:

- ``codebook`` (id, length): code lengths of at most 16 bits, optimal under that limit. Codes are
  canonical: numbered in order of (length, id).
- ``parts`` (part, tokens, base): the files' ranges in ascending doc_id order, each with the
  number of ids before it.
- ``blocks`` (part, first, doc_ids, sizes, payload, marks): runs of whole documents that
  decode on their own. ``payload`` holds the codes, most significant bit first; ``marks`` has the
  bit offset of every 256th id. ``first`` is the number of the first document in its part.

Decoding looks 16 bits up in a table of (id, length) and walks all marks of a batch in step.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from .common import map_arrow

LIMIT = 16
STRIDE = 256
BLOCK_IDS = 65_536
END_ID = 1
#: Pieces a worker remembers: words and marks of 200 bytes or so each.
PIECES = 600_000
#: Bytes of the texts that are encoded together.
TEXT_BYTES = 1 << 22
#: Fixed value: the pattern of the word tokenizer.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of ASCII and Latin letters that are their own normal form and lower-cased alike by all.
_simple = r"!-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F"
SIMPLE = re.compile(f"[{_simple}]+")
#: The same with blanks between them.
PLAIN = re.compile(f"[ \\t\\n\\r{_simple}]*")
LETTERS = r"a-z\u00DF-\u00F6\u00F8-\u017F"
_shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
#: The symbol of each byte that has none of its own: 256 and on, in order of the bytes.
SYMBOLS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _shown)}

_loaded: dict = {}


def _pieces_of(tokenizer) -> re.Pattern | None:
    """How lower-cased ``SIMPLE`` texts fall apart before any merge, where the tokenizer is of
    that kind."""
    kind = json.loads(tokenizer.to_str())
    normal = [n["type"] for n in (kind.get("normalizer") or {}).get("normalizers", [])]
    cut = (kind.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if (normal == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cut] == ["Split", "ByteLevel"]
            and cut[0]["pattern"] == {"Regex": WORD_PATTERN} and not cut[1]["add_prefix_space"]):
        return re.compile(WORD_PATTERN.replace("\\p{L}", LETTERS).replace("\\p{N}", "0-9") + "|\n")
    return None


class Pieces(dict):
    """Ids of lower-cased pieces as bytes, found when first asked for and then remembered; of more
    than ``PIECES`` those asked for lately."""

    def __init__(self, tokenizer):
        super().__init__({"\n": b""})
        self.merge, self.old = tokenizer.model.tokenize, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            symbols = piece if piece.isascii() else piece.encode().decode("latin-1").translate(SYMBOLS)
            ids = array("I", [m.id for m in self.merge(symbols)]).tobytes()
        if len(self) >= PIECES // 2:
            self.old = dict(self)
            self.clear()
            self["\n"] = b""
        self[piece] = ids
        return ids


class Encoder:
    """Ids of texts, as the tokenizer gives them.

    The given tokenizer cuts texts into pieces before it merges anything, and no piece has a blank. So
    plain texts are cut at blanks, equal parts are found by Arrow, and each different one is cut into pieces once,
    which are looked up. In other texts only the plain parts go that way; what is left goes through the
    tokenizer. A tokenizer of another kind gets whole texts.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.pattern = tokenizer, _pieces_of(tokenizer)
        self.pieces = Pieces(tokenizer)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def parts(self, lines: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain parts, each closed by a line break, one after the other, and their numbers."""
        found = list(map(self.pieces.__getitem__, self.pattern.findall(lines.lower())))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ends = np.cumsum(sizes)[sizes == 0]  # only a line break has no ids
        return np.frombuffer(b"".join(found), np.uint32), np.diff(ends, prepend=0)

    def plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts one after the other, and their numbers."""
        cut = pc.ascii_split_whitespace(texts)
        many = np.asarray(pc.list_value_length(cut), np.int64)
        coded = cut.flatten().dictionary_encode()
        lines = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        ids, sizes = self.parts(pc.binary_join(lines, "\n")[0].as_py() + "\n")
        at = coded.indices.to_numpy()
        size = sizes[at]
        end = np.cumsum(size)
        first = (np.cumsum(sizes) - sizes)[at]
        out = ids[np.repeat(first - end + size, size) + np.arange(int(end[-1]) if len(end) else 0)]
        upto = np.concatenate([[0], end])[np.cumsum(many)]
        return out, np.diff(upto, prepend=0)

    def mixed(self, text: str) -> np.ndarray:
        """Ids of a text with parts that are not plain."""
        out, run = [], []
        for part in [x.decode() for x in text.encode().split()]:
            if SIMPLE.fullmatch(part) and "<|" not in part:
                run.append(part)
                continue
            out += [self.parts("\n".join([*run, ""]))[0], self.whole(part)]
            run = []
        return np.concatenate([*out, self.parts("\n".join([*run, ""]))[0]])

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their numbers; none for NULL and empty texts."""
        plain = [bool(self.pattern and t and PLAIN.fullmatch(t) and "<|" not in t) for t in texts]
        chosen = [t for t, p in zip(texts, plain) if p]
        ids, sizes = self.plain(pa.array(chosen, pa.string())) if chosen else (_NONE, np.zeros(0, np.int64))
        if len(sizes) == len(texts):
            return ids, sizes
        runs = iter(np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else [])
        other = self.mixed if self.pattern else self.whole
        out = [next(runs) if p else other(t) if t else _NONE for t, p in zip(texts, plain)]
        return np.concatenate([_NONE, *out]), np.array([len(x) for x in out], np.int64)


_NONE = np.zeros(0, np.uint32)


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer's file, made once in a worker."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path] = Encoder(Tokenizer.from_file(path))
    return _loaded[path]


def encode_texts(path: str, texts: list[bytes | None]) -> list[np.ndarray]:
    """Ids of each text as the tokenizer gives them; none for NULL and empty texts."""
    ids, sizes = encoder(path)([None if t is None else t.decode() for t in texts])
    return np.split(ids, np.cumsum(sizes)[:-1]) if len(texts) else []


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    order = used[np.lexsort((used, counts[used]))]
    weight = counts[order].astype(np.float64)
    packages, kinds = np.zeros(0), []
    for _ in range(limit):
        both = np.concatenate([weight, packages])
        rank = np.argsort(both, kind="stable")
        kinds.append(rank < len(weight))
        merged = both[rank]
        merged = merged[:len(merged) // 2 * 2]
        packages = merged[0::2] + merged[1::2]
    take = 2 * len(order) - 2
    for is_item in reversed(kinds):
        items = int(is_item[:take].sum())
        lengths[order[:items]] += 1
        take = 2 * (take - items)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes numbered in order of (length, id)."""
    codes, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    used = np.flatnonzero(lengths)
    sizes = np.bincount(lengths[used], minlength=LIMIT + 1)
    for size in range(1, LIMIT + 1):
        code <<= size - last
        ids = used[lengths[used] == size]
        codes[ids] = code + np.arange(len(ids), dtype=np.uint64)
        code, last = code + int(sizes[size]), size
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of the ids in one bit string, and the offsets of every ``STRIDE``-th."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    start = end - size
    if not len(ids):
        return b"", start
    word, shift = start >> 5, (64 - (start & 31) - size).astype(np.uint64)
    wide = codes[ids] << shift
    out = np.zeros(int(end[-1] >> 5) + 2, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out[word[first]] += np.add.reduceat(wide >> np.uint64(32), first)
    out[word[first] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes()[:(int(end[-1]) + 7) // 8], start[::STRIDE]


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value of the next 16 bits the id and its length."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    times = 1 << (LIMIT - lengths[order].astype(np.int64))
    ids, sizes = np.repeat(order, times), np.repeat(lengths[order], times)
    pad = (1 << LIMIT) - len(ids)
    return (np.pad(ids, (0, pad)).astype(np.uint32), np.pad(sizes, (0, pad)).astype(np.int64))


def unpack(blocks: list[tuple[bytes, np.ndarray, int]],
           table: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Ids of each block (payload, marks, number of ids), all marks walked in step."""
    data = np.frombuffer(b"".join(b[0] for b in blocks) + b"\0\0\0", np.uint8).astype(np.int32)
    window = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    begin = np.cumsum([0] + [len(b[0]) for b in blocks])[:-1] * 8
    lanes = [b[1] + at for b, at in zip(blocks, begin)]
    pos = np.concatenate(lanes) if lanes else np.zeros(0, np.int64)
    out = np.empty((STRIDE, len(pos)), np.uint32)
    symbols, sizes = table
    steps = min(STRIDE, max((b[2] for b in blocks), default=0))
    for i in range(steps):
        at = np.minimum(pos >> 3, len(window) - 1)
        look = (window[at] >> (8 - (pos & 7)).astype(np.int32)) & 0xFFFF
        out[i] = symbols[look]
        pos = pos + sizes[look]
    ids, lane = [], 0
    for _, marks, n in blocks:
        ids.append(out[:, lane:lane + len(marks)].T.reshape(-1)[:n])
        lane += len(marks)
    return ids


def _tokenise(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, part, seq, n, b0, b1, b2): ids of each text as three planes of bytes, files in
    ascending order of doc_id (NULL first, then by hash of the text)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, encode = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        for batch in batches:
            length = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0), np.int64)
            # Runs of texts of together about TEXT_BYTES; a longer one is a run of its own.
            edges = np.flatnonzero(np.diff(np.cumsum(length) // TEXT_BYTES, prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(length))):
                ids, sizes = encode(batch.column(1).slice(a, b - a).to_pylist())
                if len(ids) and ids.max() >> 24:
                    raise ValueError("ids of 2**24 and more do not fit the draft")
                end = np.cumsum(sizes + 1)
                closed = np.empty(int(end[-1]), "<u4")
                last = np.zeros(len(closed), bool)
                last[end - 1] = True
                closed[last], closed[~last] = end_id, ids
                planes = closed.view(np.uint8).reshape(-1, 4)
                offsets = pa.py_buffer(np.concatenate([[0], end]).astype(np.int32))
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.array(np.full(n, part, np.int32)),
                     pa.array(np.arange(seq, seq + n)), pa.array(sizes + 1)]
                    + [pa.Array.from_buffers(pa.binary(), n, [
                        None, offsets, pa.py_buffer(np.ascontiguousarray(planes[:, i]))]) for i in range(3)],
                    names=["doc_id", "part", "seq", "n", "b0", "b1", "b2"])
                seq += n

    return map_arrow(rows, run, "doc_id long, part int, seq long, n long, b0 binary, b1 binary, b2 binary")


def _ids(b0: bytes, b1: bytes, b2: bytes) -> np.ndarray:
    x = [np.frombuffer(b, np.uint8).astype(np.uint32) for b in (b0, b1, b2)]
    return x[0] | (x[1] << 8) | (x[2] << 16)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the ids of every text (NULL: empty), each closed by ``end_id``, to ``path``.

    Repeated rows are written as often as they come. An empty table gives empty folders. Very long texts are
    encoded whole, within one task. The ids must be below 2**24 and at most 65,536 of them in use; more
    are an error. Extra columns are not read.
    """
    spark = docs.sparkSession
    draft = scratch_path(spark, "ids")
    _tokenise(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(draft)
    ids = spark.read.parquet(draft)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _loaded.clear()  # all texts are encoded: a worker need not remember their pieces
        total = np.zeros(0, np.int64)
        for batch in batches:
            for planes in zip(*(c.to_pylist() for c in batch.columns)):
                n = np.bincount(_ids(*planes), minlength=len(total))
                n[:len(total)] += total
                total = n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    # One row per id in use, at most 65,536.
    counted = (map_arrow(ids.select("b0", "b1", "b2"), tally, "id long, n long").groupBy("id")
               .agg(F.sum("n").alias("n")).limit((1 << LIMIT) + 1).collect())
    counts = np.zeros(max((r["id"] for r in counted), default=0) + 1, np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    codes = canonical(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)],
                          "id long, length int").coalesce(1).write.parquet(f"{path}/codebook")
    # One row per part.
    parts = sorted((r["part"], r["tokens"]) for r in ids.groupBy("part").agg(
        F.sum("n").alias("tokens")).collect())
    base = np.cumsum([0] + [t for _, t in parts]).tolist()
    spark.createDataFrame([(p, t, b) for (p, t), b in zip(parts, base)],
                          "part int, tokens long, base long").coalesce(1).write.parquet(f"{path}/parts")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _loaded.clear()
        names = ["part", "first", "doc_ids", "sizes", "payload", "marks"]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(),
                 pa.list_(pa.int64())]

        def close(rows):
            payload, marks = pack(np.concatenate([r[4] for r in rows]), codes, lengths)
            return (rows[0][1], rows[0][2], [r[0] for r in rows], [r[3] for r in rows], payload, marks)

        for batch in batches:
            made, run, held = [], [], 0
            for doc_id, part, seq, n, *planes in zip(*(c.to_pylist() for c in batch.columns)):
                if run and (held + n > BLOCK_IDS or run[-1][1:3] != (part, seq - 1)):
                    made.append(close(run))
                    run, held = [], 0
                run.append((doc_id, part, seq, n, _ids(*planes)))
                held += n
            if run:
                made.append(close(run))
            for i in range(0, len(made), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*made[i:i + 64]), kinds)], names=names)

    map_arrow(
        ids.select("doc_id", "part", "seq", "n", "b0", "b1", "b2"), blocks, "part int, first long, doc_ids array<long>, sizes array<long>, payload binary, "
                "marks array<long>").write.option("compression", "none").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """One row per written document: (part, seq, doc_id, n_tokens, ids array<long>).

    With ``digest`` the ids give way to ``ids_crc32``, the unsigned crc32 of all of them as
    little-endian unsigned 32-bit integers.
    """
    book = spark.read.parquet(f"{path}/codebook").collect()  # at most 65,536 rows
    lengths = np.zeros(max((r["id"] for r in book), default=0) + 1, np.uint8)
    for r in book:
        lengths[r["id"]] = r["length"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths)
        names = ["part", "seq", "doc_id", "n_tokens", "ids_crc32" if digest else "ids"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(),
                 pa.int64() if digest else pa.list_(pa.int64())]
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                rows = list(zip(*(c.to_pylist() for c in batch.slice(at, 32).columns)))
                ids = unpack([(r[4], np.array(r[5], np.int64), sum(r[3])) for r in rows], table)
                made = []
                for (part, first, doc_ids, sizes, _, _), all_ids in zip(rows, ids):
                    end = 0
                    for i, (doc_id, n) in enumerate(zip(doc_ids, sizes)):
                        one, end = all_ids[end:end + n], end + n
                        made.append((part, first + i, doc_id, n, zlib.crc32(
                            one.astype("<u4").tobytes()) if digest else one.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)

    blocks = spark.read.parquet(f"{path}/blocks").select(
        "part", "first", "doc_ids", "sizes", "payload", "marks")
    return map_arrow(blocks, decode, "part int, seq long, doc_id long, n_tokens long, "
                     + ("ids_crc32 long" if digest else "ids array<long>"))


def report(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids to ``path``, read them back: doc_id, start, n_tokens, ids_crc32.

    ``start`` is the number of ids of all documents before, in the order of the files.
    """
    from pyspark.sql import Window

    write(docs, path, tokenizer, end_id)
    spark = docs.sparkSession
    rows = read(spark, path, digest=True)
    bases = spark.read.parquet(f"{path}/parts").select("part", "base")  # one row per part
    before = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return rows.withColumn("before", before).join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
