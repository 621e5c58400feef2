"""Token ids as Parquet list columns.

Documents are range-partitioned and sorted by doc_id, tokenized, and written
as one row per document (doc_id, part, n_tokens, ids).  Writer settings:
Parquet format 2 pages (delta-encoded integers, dictionary where it pays),
row groups of bounded bytes, pages of bounded rows with column indexes, so a
reader can take metadata columns or a doc_id range without touching other
ids.  Each row holds the number of ids that its part has before it, so a
document's place in the whole is that and the totals of earlier parts (one
row per written part): ``with_offsets`` reads both back with the ids.

Encoding: texts are cut where byte-level BPE has a token bound for certain
(``Encoder``), and each distinct piece is encoded once per worker (a cache of
bounded size, in two generations: what the older one holds is kept when it
is met again).  With ``added_tokens`` the strings of the tokenizer's added
tokens are those tokens, as in the library by itself; without, they are
ordinary text.  The tokenizer file is read on the workers from a path given as a parameter.

Defined results: a null or empty text is the end id alone; a null doc_id
sorts first; rows that repeat a doc_id follow each other in any fixed order
(their text's hash); an empty table gives no rows.  Only doc_id and text are
read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize
from tessera.llm.textnp import cut_by_bytes
from tessera.session import scratch_path

END_ID = 2
ROW_GROUP_BYTES = 16 << 20
CHUNK_BYTES = 8 << 20  # texts encoded at a time
PAGE_ROWS = 1_000
CACHE_PIECES = 400_000  # of each generation

# A space that a piece may start with: the character before it is visible for certain.
_VISIBLE = "!-~\u00a1-\u167f\u3041-\u9fff"
_CUT = re.compile(f"(?<=[{_VISIBLE}]) ")
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_PLAIN = re.compile(f"\n?[{_VISIBLE}]*[{_VISIBLE}]")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: itself where it is printable
    Latin-1, else the next code point from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    """Encodes texts to little-endian 32-bit ids by cached pieces.

    Three places are token bounds for certain: before a single space between
    visible characters, around a single newline between visible characters,
    and between a letter or digit and the ASCII marks that end a word.  Texts
    are cut there; what is left is encoded by the tokenizer, words of letters
    and runs of marks by its model alone (one is one unit for it).  A text that holds
    any other white space is cut at the certain spaces only.  A text that
    holds an added token's string is encoded by the tokenizer as a whole
    where ``added_tokens`` are asked for."""

    def __init__(self, tokenizer_path: str, added_tokens: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = not added_tokens
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.word = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.known: dict[str, bytes] = {}  # pieces after a space, without it; those after a newline, with it; no ids: not plain
        self.older: dict[str, bytes] = {}  # ``known`` before it was full
        self.heads: dict[str, bytes] = {}  # pieces as they are
        self.tails: dict[str, bytes] = {}  # marks that end a word
        self._learn_heads(["\n"])
        self.newline = self.heads["\n"]

    def _raw(self, pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _learn_heads(self, pieces: list[str]) -> None:
        self.heads.update(zip(pieces, self._raw(pieces)))

    def _units(self, letters: list[str]) -> Iterator[bytes]:
        """Ids of units that are written in the model's letters."""
        units = list(map(self.word, letters))
        ids = array("I", [t.id for unit in units for t in unit]).tobytes()
        ends = [0, *accumulate(map(len, units))]
        return (ids[4 * a:4 * b] for a, b in pairwise(ends))

    def _letters(self, word: str) -> str | None:
        """The model's letters of a word that is one unit for certain."""
        if not word.isalpha():
            return None
        if word.isascii():
            return word
        return word.encode().decode("latin-1").translate(self.letters) if max(word) < "\u0250" else None

    def _learn(self, pieces: list[str]) -> None:
        """Learn pieces that are not known.  Marks at the end of a word are a
        unit of their own, so such a piece follows from the word's."""
        known, older, space, letters_of = self.known, self.older, self.space, self._letters
        words, letters, marked, rest = [], [], [], []
        for piece in pieces:
            if (ids := older.get(piece)) is not None:
                known[piece] = ids
            elif (of := letters_of(piece)) is not None:
                words.append(piece)
                letters.append(space + of)
            elif (stem := piece.rstrip(_MARKS)) != piece and stem[-1:].isalnum() and stem[-1] < "\u0250":
                marked.append((piece, stem))
            else:
                rest.append(piece)
        known.update(zip(words, self._units(letters)))
        lines = [(p, of) for p in rest if p[:1] == "\n" and (of := letters_of(p[1:])) is not None]
        known.update(zip([p for p, _ in lines], map(self.newline.__add__, self._units([of for _, of in lines]))))
        rest = [p for p in rest if p not in known]
        known.update(zip(rest, repeat(b"")))
        plain = [p for p in rest if _PLAIN.fullmatch(p)]
        known.update(zip(plain, self._raw([p if p[0] == "\n" else " " + p for p in plain])))
        if marked:
            if stems := list({s for _, s in marked}.difference(known)):
                self._learn(stems)
            if tails := list({p[len(s):] for p, s in marked}.difference(self.tails)):
                if len(self.tails) > CACHE_PIECES:
                    self.tails.clear()
                    tails = list({p[len(s):] for p, s in marked})
                self.tails.update(zip(tails, self._units(tails)))
            for piece, stem in marked:
                known[piece] = (ids := known[stem]) and ids + self.tails[piece[len(stem):]]

    def _plainly(self, text: str) -> bytes:
        parts = _CUT.split(text)
        pieces = [parts[0], *[" " + p for p in parts[1:]]]
        if len(self.heads) > CACHE_PIECES:
            self.heads.clear()
        if missing := [p for p in set(pieces) if p not in self.heads]:
            self._learn_heads(missing)
        return b"".join([self.heads[p] for p in pieces])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        whole = {k for k, t in enumerate(texts) if any(a in t for a in self.added)}
        rest = [t for k, t in enumerate(texts) if k not in whole]
        plain = iter(self._encode_plain(rest) if rest else ())
        return [self._raw([t])[0] if k in whole else next(plain) for k, t in enumerate(texts)]

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """Each distinct piece of the texts is looked up once."""
        # the first piece is taken like one after a newline, less that newline
        lists = pc.split_pattern(pa.array(["\n" + t.replace("\n", " \n") for t in texts], pa.large_string()), " ")
        pieces, bounds = lists.flatten().dictionary_encode(), lists.offsets.to_numpy()
        wanted = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > CACHE_PIECES:
            self.older, self.known = self.known, {}
        self._learn([p for p in wanted if p not in self.known])
        ids = list(map(self.known.__getitem__, wanted))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        code = pieces.indices.to_numpy()
        size = sizes[code]
        plainly = np.minimum.reduceat(size, bounds[:-1]) == 0
        ends = np.append(0, np.cumsum(size))
        at = np.repeat((np.cumsum(sizes) - sizes)[code] - ends[:-1], size)
        at += np.arange(ends[-1])
        joined = flat[at]
        skip = len(self.newline) // 4
        return [self._plainly(t) if odd else joined[x + skip:y].tobytes()
                for t, odd, x, y in zip(texts, plainly.tolist(), ends[bounds[:-1]].tolist(), ends[bounds[1:]].tolist())]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(tokenizer_path: str, added_tokens: bool = False) -> Encoder:
    """One encoder per worker process, file and treatment of added tokens."""
    key = tokenizer_path, added_tokens
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, added_tokens: bool = False) -> DataFrame:
    """doc_id, part, before (ids of the part ahead of the row), n_tokens, ids
    in ascending doc_id order within and over parts.  Rows of one doc_id
    follow each other by their text's hash, equal ones as they are read."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = [F.xxhash64("text"), F.col("at")]
    ordered = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("at"))
               .repartitionByRange(parts, "doc_id", *tie).sortWithinPartitions("doc_id", *tie)
               .select("doc_id", "text", F.spark_partition_id().alias("part")))
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, before = encoder(tokenizer_path, added_tokens), 0
        for whole in batches:  # a batch lies in one part
            for batch in cut_by_bytes(whole, 1, CHUNK_BYTES):
                raw = [r + end for r in enc.encode_all(batch.column(1).to_pylist())]
                counts = np.array([len(r) // 4 for r in raw], np.int64)
                ends = np.append(0, np.cumsum(counts))
                ids = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(before + ends[:-1]), pa.array(counts), lists],
                                                 names=["doc_id", "part", "before", "n_tokens", "ids"])
                before += int(ends[-1])
    return ordered.mapInArrow(encode, "doc_id long, part int, before long, n_tokens long, ids array<int>")


def write_ids(tokens: DataFrame, path: str) -> None:
    (tokens.write.option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "true")
     .option("parquet.block.size", str(ROW_GROUP_BYTES)).option("parquet.page.row.count.limit", str(PAGE_ROWS))
     .option("compression", "zstd").parquet(path))


def read_ids(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return spark.read.parquet(path).select(*(columns or ["doc_id", "part", "before", "n_tokens", "ids"]))


def with_offsets(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the written files."""
    def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            values = np.ascontiguousarray(np.asarray(lists.values), "<u4")
            off = np.asarray(lists.offsets)
            crc = [zlib.crc32(values[a:b]) for a, b in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(off), pa.int64()), pa.array(crc, pa.int64())],
                                             names=["doc_id", "part", "before", "n_tokens", "ids_crc32"])
    sums = materialize(read_ids(spark, path).mapInArrow(checksum, "doc_id long, part int, before long, n_tokens long, ids_crc32 long"), "sums")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = sums.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return sums.join(parts, "part").select("doc_id", (F.col("base") + F.col("before")).cast("bigint").alias("start"), "n_tokens", "ids_crc32")


def encode_to_files(docs: DataFrame, tokenizer_path: str, added_tokens: bool = False) -> DataFrame:
    """Write the ids under the shared folder and return ``with_offsets``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token_ids")
    write_ids(tokenized(docs, tokenizer_path, added_tokens=added_tokens), path)
    return with_offsets(spark, path)
