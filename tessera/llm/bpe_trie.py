"""BPE encoding and decoding with end-of-word marks over a trie of words.

A batch's distinct unknown words form a trie (symbols: UTF-8 bytes, the
word's last byte marked).  Each node stands for one prefix and has one state:
the last token of that prefix's encoding.  The walk is depth-first: in sorted
order each word goes back to the node where it leaves the word before, and
states follow from there down, so what words share at the front is encoded
once and only the path to the present node is held.  A child gets its state
from its ancestors': among the tokens that end the prefix, the right one is
whole by itself and stays apart from the last token of what is before it.  A
word's ids follow by stepping back from its leaf.  Known words live as long as
the worker, within a bound beyond which all but the present ones go.

Texts become words as the tokenizer file says: added tokens are cut out
first; the rest is normalised (NFC, lower case) and split.  Texts of code
points below U+0250 take a table of letters and digits; others, where Unicode
versions could differ, are normalised and split by the tokenizer library.

Decoding joins the tokens' strings by spaces (the file has no decoder).

Defined results: a null or empty text, or one of white space, has no tokens
and decodes to an empty string; null and repeated doc_ids give a row each;
an empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.textnp import cut_by_bytes

MAX_WORDS = 250_000  # words a worker knows
MAX_PAIRS = 250_000  # pairs of tokens a worker has judged
PART_BYTES = 4 << 20  # texts that a worker takes at once
PLAIN_END = 0x250

_PLAIN = re.compile(f"[\0-{chr(PLAIN_END - 1)}]*")
# White space below PLAIN_END, by Unicode's White_Space property.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0"


def byte_letters() -> list[str]:
    """Byte-level BPE's letter for each byte: itself where it is printable
    Latin-1, else the next code point from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def plain_pattern(contractions: str) -> re.Pattern:
    """The split pattern over code points below ``PLAIN_END``."""
    of = {"L": [], "N": []}
    for c in map(chr, range(PLAIN_END)):
        of.setdefault(unicodedata.category(c)[0], []).append(re.escape(c))
    letters, digits, white = "".join(of["L"]), "".join(of["N"]), re.escape(_WHITE)
    return re.compile(f"{contractions}|[{letters}]+|[{digits}]|[^{white}{letters}{digits}]+")


class Merges:
    """Vocabulary over symbols (chr of a byte, plus 256 for a word's last)
    and the plain merge procedure, used on single tokens and pairs only."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        byte = {letter: chr(b) for b, letter in enumerate(byte_letters())}

        def symbols(token: str) -> str:
            if token.endswith(suffix) and token != suffix:
                body = [byte[c] for c in token[:-len(suffix)]]
                body[-1] = chr(ord(body[-1]) + 256)
                return "".join(body)
            return "".join(byte[c] for c in token)

        self.ids = {symbols(t): k for t, k in vocab.items()}
        self.strings = {k: t for t, k in vocab.items()}
        self.text = {k: s for s, k in self.ids.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for at, pair in enumerate(merges):
            a, b = (vocab[t] for t in (pair.split(" ") if isinstance(pair, str) else pair))
            made = vocab[self.strings[a] + self.strings[b]]
            self.rank[a, b] = at, made
            self.parts[made] = at, a, b
        self.longest: dict[str, int] = {}  # of the tokens that end in a symbol
        for s in self.ids:
            self.longest[s[-1]] = max(len(s), self.longest.get(s[-1], 0))
        self.whole: dict[int, bool] = {}
        self.known_fits: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = {}, {}

    def merged(self, symbols: str) -> list[int]:
        """Merge the lowest-ranked adjacent pair, leftmost first, to the end."""
        out, rank = [self.ids[s] for s in symbols], self.rank
        while len(out) > 1:
            best = min(((rank[p][0], k) for k, p in enumerate(zip(out, out[1:])) if p in rank), default=None)
            if best is None:
                break
            k = best[1]
            out[k:k + 2] = [rank[out[k], out[k + 1]][1]]
        return out

    def edge(self, token: int, right: int) -> list[tuple[int, int]]:
        """What stands at a token's left or right edge while it is merged:
        (token, rank at which it is merged further)."""
        if token not in self.edges[right]:
            out, at, until = [], token, 1 << 62
            while True:
                out.append((at, until))
                if at not in self.parts:
                    break
                until, *halves = self.parts[at]
                at = halves[right]
            self.edges[right][token] = out
        return self.edges[right][token]

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` is what its string merges to and, after the token
        ``before`` (-1: nothing), no merge crosses the bound between the two.
        Of equal merges the left one comes first."""
        if token not in self.whole:
            self.whole[token] = self.merged(self.text[token]) == [token]
        if not self.whole[token]:
            return False
        if before < 0:
            return True
        rank, following = self.rank, self.edge(token, 0)
        for x, until_x in self.edge(before, 1):
            for y, until_y in following:
                cross = rank.get((x, y))
                if cross is not None and cross[0] < until_x and cross[0] <= until_y:
                    return False
        return True

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of ``words``, which are distinct and sorted: a depth-first walk
        over their trie.  ``last[d]`` is the last token of the present path's
        first ``d`` symbols, ``start[d]`` where it starts."""
        token_of, longest, known = self.ids.get, self.longest, self.known_fits
        out, before, last, start = [], "", [-1], [0]
        for word in words:
            shared, both = 0, min(len(word), len(before))
            while shared < both and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:], start[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                at = max(0, end - longest[word[end - 1]])
                while True:
                    token = token_of(word[at:end])
                    if token is not None:
                        key = last[at] << 20 | token
                        fits = known.get(key)
                        if fits is None:
                            if len(known) > MAX_PAIRS:
                                known.clear()
                            fits = known[key] = self.fits(last[at], token)
                        if fits:
                            break
                    at += 1
                last.append(token)
                start.append(at)
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at = start[at]
            ids.reverse()
            out.append(ids)
            before = word
        return out


class Coder:
    """Encodes by one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        model, splits = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        self.path, self.library = path, None
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_added = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")
        self.byte = {ord(letter): b for b, letter in enumerate(byte_letters())}
        # the alternatives before the classes are literal strings
        self.plain = plain_pattern(splits[0]["pattern"]["Regex"].split("|[", 1)[0])
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        low = text.lower()
        if low.isascii() or _PLAIN.fullmatch(text) and _PLAIN.fullmatch(low):
            return self.plain.findall(low)
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
        units = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(w.translate(self.byte).encode("latin-1")).decode("utf-8", "surrogateescape") for w, _ in units]

    def learn(self, words: set[str]) -> None:
        marked = {}
        for word in words:
            raw = word.encode("utf-8", "surrogateescape").decode("latin-1")
            marked[raw[:-1] + chr(ord(raw[-1]) + 256)] = word
        order = sorted(marked)
        for raw, ids in zip(order, self.merges.encode(order)):
            self.known[marked[raw]] = array("I", ids).tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = []
        for text in texts:
            parts = self.cut_added.split(text) if "<" in text else [text]
            cut.append([p if n % 2 else self.words(p) for n, p in enumerate(parts)])
        wanted = set(chain.from_iterable(p for parts in cut for p in parts if isinstance(p, list)))
        if len(self.known) > MAX_WORDS:
            self.known = {w: self.known[w] for w in wanted if w in self.known}
        self.learn(wanted.difference(self.known))
        ids, out = self.known.__getitem__, []
        for parts in cut:
            out.append(b"".join(b"".join(map(ids, p)) if isinstance(p, list)
                                else self.added[p].to_bytes(4, "little") for p in parts))
        return out


class Decoder:
    """Decodes by one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        self.strings = {k: t for t, k in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}

    def decode_all(self, packed: list[bytes]) -> list[str]:
        """The tokens' strings, joined by spaces."""
        string = self.strings.__getitem__
        return [" ".join(map(string, np.frombuffer(ids, "<u4").tolist())) for ids in packed]


@lru_cache(maxsize=4)
def coder(path: str) -> Coder:
    """One per worker process and file."""
    return Coder(path)


@lru_cache(maxsize=4)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian unsigned 32-bit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(cut_by_bytes(b, 1, PART_BYTES) for b in batches):
            packed = coder(tokenizer_path).encode_all([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()),
                                              pa.array(packed, pa.binary())], names=["doc_id", "n_tokens", "ids"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(tokens: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded from the columns of ``encode``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(cut_by_bytes(b, 2, PART_BYTES) for b in batches):
            text = decoder(tokenizer_path).decode_all([p or b"" for p in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())],
                                             names=["doc_id", "n_tokens", "ids", "decoded"])
    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
