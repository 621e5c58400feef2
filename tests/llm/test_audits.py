"""BPE over a trie, filter interactions and source divergence against brute
force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from tests.llm.conftest import SF, rows_of
from tokenizers import Tokenizer

from tessera.llm import bpe_trie, divergence, filter_audit, queries

UNIT = 1_000_000_000
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def coder():
    return bpe_trie.Coder(WORD_BPE)


def fuzz() -> list[str]:
    rng = random.Random(3)
    bits = ["a", "b", "the", "ing", "'s", "'LL", "'", " ", "\n", "é", "İ", "Σ", "ΑΣ", "²", "5", "<|endoftext|>", "<|startoftext|>", "é", "漢",
            "🙂", "\x1c", "\x85", "\xa0", "_", "-", "ß", "ǅ", "aaaaaaaaa", "ſ", "\x00", "K", "Å", "Ɖ", "<", "</w>"]
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    out += ["".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    out += ["".join(chr(rng.randrange(0x250)) for _ in range(60)) for _ in range(300)]
    return out + ["ab" * 5000, "a" * 3000, "the" * 400, "", " \n\t"]


def test_trie_encodes_as_the_library(coder, library):
    texts = fuzz()
    packed = coder.encode_all(texts)
    for text, ids, back in zip(texts, packed, bpe_trie.Decoder(WORD_BPE).decode_all(packed)):
        expect = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expect, text
        assert back == library.decode(expect, skip_special_tokens=False)


def test_known_words_start_anew(library, monkeypatch):
    monkeypatch.setattr(bpe_trie, "MAX_WORDS", 50)
    monkeypatch.setattr(bpe_trie, "MAX_PAIRS", 50)
    coder, texts = bpe_trie.Coder(WORD_BPE), fuzz()[:400]
    for k in range(0, len(texts), 3):
        expect = [e.ids for e in library.encode_batch(texts[k:k + 3], add_special_tokens=False)]
        assert [np.frombuffer(p, "<u4").tolist() for p in coder.encode_all(texts[k:k + 3])] == expect
    assert len(coder.known) < 2_000


def test_walk_over_shared_prefixes(coder, monkeypatch):
    """Each node of the trie is judged once, whichever words pass it."""
    words = sorted("".join([*w[:-1], chr(ord(w[-1]) + 256)]) for w in ("interact", "interacts", "interior", "inter", "aaaaaaa", "ababab"))
    assert coder.merges.encode(words) == [coder.merges.merged(w) for w in words]

    class Seen(dict):
        ends = 0

        def __getitem__(self, symbol):
            Seen.ends += 1
            return super().__getitem__(symbol)
    monkeypatch.setattr(coder.merges, "longest", Seen(coder.merges.longest))
    coder.merges.encode(words)
    assert Seen.ends == len({w[:k] for w in words for k in range(1, len(w) + 1)})


def test_trie_bpe_query(spark, odd, none, clashing, tables, library):
    def expect(docs):
        out = []
        for r in docs.select("doc_id", "text").collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            out.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), text))
        return sorted(out, key=repr)

    for docs in (odd, clashing, tables["documents"], none):
        back = bpe_trie.decode(bpe_trie.encode(docs, WORD_BPE), WORD_BPE).collect()
        assert sorted([(r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), r.decoded) for r in back], key=repr) == expect(docs)
    rows = rows_of(queries.QUERIES["op11_trie_bpe"](spark, SF))
    assert rows == sorted([(d, n, h, hashlib.sha256(t.encode()).hexdigest()) for d, n, h, t in expect(tables["documents"])], key=repr)


def expect_audit(docs, labels):
    """Every order applied to every document, one after the other."""
    rows = [(r.doc_id, r.text or "", r.source or "") for r in docs.select("doc_id", "text", "source").collect()]
    marks = {}
    for r in labels.collect():
        good, toxic = marks.get(r.doc_id, (0, 0))
        marks[r.doc_id] = (max(good, int(r.quality == 1)), max(toxic, int(r.toxic == 1)))
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t] = min(least.get(t, d), d)
    fails = []
    for d, t, part in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append((part, {k for k, bad in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            bool(set(t) & set("#$%&*|")), d is not None and d > least[t])) if bad}, *(marks.get(d, (0, 0)) if d is not None else (0, 0))))
    out, shapley = [], Counter()
    for part in {f[0] for f in fails}:
        for order in permutations("ABCDE"):
            left = [f for f in fails if f[0] == part]
            gone = []
            for step, k in enumerate(order, 1):
                now = [f for f in left if k in f[1]]
                left = [f for f in left if k not in f[1]]
                shapley[part, k] += len(now)
                out.append([part, "".join(order), step, len(left), len(now), sum(k in f[1] for f in gone),
                            sum(f[1] == {k} for f in fails if f[0] == part), sum(f[2] for f in now), sum(f[3] for f in now), k])
                gone += now
    return sorted((*r[:-1], shapley[r[0], r[-1]]) for r in out)


def test_filter_audit(spark, odd, none, clashing, tables):
    labels = tables["labels"]
    more = labels.union(spark.createDataFrame([(9, 1, 0), (9, 0, 1), (None, 1, 1), (-5, 1, 1)], labels.schema))
    for docs, marks in ((odd, more), (clashing, more), (tables["documents"], labels)):
        assert sorted(tuple(r) for r in filter_audit.audit(docs, marks).collect()) == expect_audit(docs, marks)
    assert filter_audit.audit(none, labels).count() == 0
    assert filter_audit.audit(odd, labels.limit(0)).count() == len({r.source or "" for r in odd.collect()}) * 600


def test_intervals_cover_each_order_once():
    for n in (1, 3, 5):
        orders = list(permutations(range(n)))
        for mask in range(1 << n):
            steps = [0] * len(orders)
            for step, at, end in filter_audit.intervals(mask, n):
                for rank in range(at, end):
                    assert steps[rank] == 0
                    steps[rank] = step
            assert steps == [next((k for k, x in enumerate(o, 1) if mask >> x & 1), 0) for o in orders]
    assert len(filter_audit.differences(5)) < 4_000


def expect_divergence(docs, min_docs=10, ranks=10):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for r in docs.select("text", "lang", "source").collect():
        lang, source, words = r.lang or "", r.source or "", term.findall((r.text or "").translate(lower))
        groups.add((lang, source))
        counts[lang, source].update(words)
        in_docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(w for w, n in in_docs[lang].items() if n >= min_docs)
        sources = sorted((s for at, s in groups if at == lang), key=str.encode)
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def shares(c):
            total = sum(c[w] for w in kept) + 2 * len(kept)
            return [1 + UNIT * (c[w] + 2) // total for w in kept]
        own, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = [(t, sum(map(f, own[s], own[t]))) for t in sources if t != s]
            tops = [(w, f(a, b)) for w, a, b in zip(kept, own[s], q) if counts[lang, s][w] > 0 and a > b]
            for part, items, most in (("pair", pairs, None), ("term", tops, ranks)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, w, v, k) for k, (w, v) in enumerate(items[:most], 1)]
    return sorted(out)


def divergence_rows(docs, **how):
    return sorted(tuple(r) for r in divergence.audit(docs, **how).collect())


def test_divergence(spark, odd, none, clashing, tables):
    many = odd.unionAll(odd).unionAll(odd).unionAll(odd).unionAll(odd).unionAll(odd)
    ties = spark.createDataFrame([(k, " ".join(f"t{w}é W{'x' * (w % 7)}" for w in range(k % 5, 60)), "en", f"s{k % 4}", 0) for k in range(60)], odd.schema)
    for docs in (odd, many, clashing, tables["documents"], ties, ties.unionAll(odd)):
        assert divergence_rows(docs) == expect_divergence(docs)
    assert divergence.audit(none).count() == 0


def test_divergence_in_small_pieces(spark, monkeypatch):
    """Many sources, tiles and task tables smaller than the data."""
    for name, value in (("TASK_TERMS", 50), ("TILE", 4), ("TILE_CELLS", 64), ("HELD_CELLS", 40)):
        monkeypatch.setattr(divergence, name, value)
    rng = random.Random(5)
    rows = [(k, " ".join(f"{rng.choice('abcdefgh')}{rng.choice('xyz')}" for _ in range(30)), rng.choice("lm"), f"s{rng.randrange(11)}", 0) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert divergence_rows(docs) == expect_divergence(docs)


def test_share_is_exact_beyond_64_bits(spark):
    n, total, terms = 7 * 10 ** 15 + 3, 9 * 10 ** 17 + 1, 10 ** 8
    row = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long").select(divergence.share("n", "total")).first()
    assert row[0] == 1 + UNIT * (n + 2) // (total + 2 * terms)
