"""Exact, near-duplicate, unit and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import prose, rows_of

from tessera.llm import bwt_dedup, components, exact_dedup, line_dedup, minhash_dedup, textnp

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def components_of(rows, threshold=75):
    """(doc_id, set size) -> least id of its component; rows sharing an id are one."""
    nodes = [(-(1 << 63) if i is None else i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for k, (i, s) in enumerate(nodes):
        for j, t in nodes[:k]:
            if s and t and 100 * len(s & t) >= threshold * len(s | t) and root(i) != root(j):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [(i, len(s), root(i)) for i, s in nodes]


def expect_link(docs):
    back = lambda x: None if x == -(1 << 63) else x
    return sorted(((back(i), n, back(c), i == c) for i, n, c in components_of([(r.doc_id, r.text) for r in docs.collect()])), key=repr)


def test_near_duplicates_match_brute_force(odd, tables):
    for docs in (odd, tables["documents"]):
        assert rows_of(minhash_dedup.link(docs)) == expect_link(docs)


def test_near_duplicates_awkward_tables(none, clashing, odd):
    assert minhash_dedup.link(none).count() == 0
    assert rows_of(minhash_dedup.link(clashing)) == rows_of(minhash_dedup.link(odd))
    assert minhash_dedup.keep_one(none).count() == 0
    kept = minhash_dedup.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-5, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17]


def test_rounds_find_links_between_members_that_the_first_centre_lacks(spark, monkeypatch):
    """One key shared by all, links only along a chain: needs later centres."""
    monkeypatch.setattr(minhash_dedup, "BLOCK_NODES", 3)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 12:i * 12 + 130])) for i in range(20)] + [(100 + i, f"lone{i} " * 3 + "a b c d e f") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(minhash_dedup.link(docs)) == expect_link(docs)


def test_signature_estimate_is_unbiased():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.2, 0.5, 0.75, 0.9):
        n = 600
        both = int(2 * n * share / (1 + share))
        values = textnp.mix64(rng.integers(0, 1 << 62, 2 * n).astype(np.uint64))
        sets = [np.unique(values[:n]), np.unique(values[n - both:2 * n - both])]
        packed = minhash_dedup._packed(minhash_dedup._minima(sets)).view(np.uint64)
        x = packed[0] ^ packed[1]
        folded = (x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)
        unequal = sum(bin(int(v)).count("1") for v in folded)
        errors.append(((1 - unequal / minhash_dedup.HASHES) - 0.25) / 0.75 - share)
    assert max(map(abs, errors)) < 0.2 and abs(sum(errors)) < 0.3


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150)] + [(300, 300 + k) for k in range(1, 50)] + [(7, 7)]
    found = dict(components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(1, 41)}, 150: 100, 200: 100, **{300 + k: 300 for k in range(1, 50)}}


def test_merge_labels(spark):
    labels = spark.createDataFrame([(2, 1), (3, 1), (5, 4), (8, 7)], "node long, label long")
    links = spark.createDataFrame([(3, 5), (9, 8), (11, 10)], "a long, b long")
    got = dict(components.merge_labels(labels, links).collect())
    assert got == {2: 1, 3: 1, 4: 1, 5: 1, 8: 7, 9: 7, 11: 10}


def expect_exact(docs):
    rows = docs.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    out = []
    for r in rows:
        ids = groups[r.text or ""]
        winner = max((i for i in ids if i is not None), default=None)
        out.append((r.doc_id, winner, len(ids), r.doc_id == winner, hashlib.sha256((r.text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup_matches_brute_force(odd, tables, none, clashing):
    for docs in (odd, tables["documents"], none, clashing):
        assert rows_of(exact_dedup.dedup(docs).drop("in_history")) == expect_exact(docs)


def test_exact_dedup_regroups_texts_with_one_digest(spark):
    texts = spark.createDataFrame([(1, "a", "d"), (2, "b", "d"), (3, "a", "d")], "doc_id long, text string, digest string")
    texts = texts.selectExpr("doc_id", "text", "cast(digest as binary) digest")
    groups = spark.createDataFrame([("d", 3, 3, True)], "digest string, winner long, size long, in_history boolean") \
        .selectExpr("cast(digest as binary) digest", "winner", "size", "in_history")
    got = exact_dedup._checked(texts, groups).select("doc_id", "keep_id", "group_size").collect()
    assert sorted(map(tuple, got)) == [(1, 3, 2), (2, 2, 1), (3, 3, 2)]


def test_perfect_hash_is_minimal():
    import pandas as pd
    keys = pd.Series([hashlib.sha256(str(i).encode()).digest() for i in range(3000)])
    slots, pilots = exact_dedup._place(keys)
    assert sorted(slots) == list(range(3000)) and len(pilots) == 750


def expect_cut(rows):
    rows = sorted(((-(1 << 63) if i is None else i, (t or "").encode()) for i, t in rows), key=lambda r: r[0])
    owner = {}
    for i, raw in rows:
        for k in range(len(raw) - 49):
            owner.setdefault(raw[k:k + 50], i)
    out = []
    for i, raw in rows:
        gone = np.zeros(len(raw) + 1, np.int32)
        for k in range(len(raw) - 49):
            if owner[raw[k:k + 50]] < i:
                gone[k] += 1
                gone[k + 50] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        spans = int((np.diff(np.append(0, gone.astype(np.int8))) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((None if i == -(1 << 63) else i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_substring_dedup_matches_brute_force(odd, tables, none, clashing):
    for docs in (odd, tables["documents"], none, clashing):
        got = rows_of(bwt_dedup.remove_repeats(docs).drop("kept"))
        assert got == expect_cut([(r.doc_id, r.text) for r in docs.collect()])


def test_substring_dedup_spreads_hot_minimizers(odd, tables, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "HOT", 1)
    for docs in (odd, tables["documents"]):
        got = rows_of(bwt_dedup.remove_repeats(docs).drop("kept"))
        assert got == expect_cut([(r.doc_id, r.text) for r in docs.collect()])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text("ab", min_size=60, max_size=84), min_size=1, max_size=12, unique=True))
def test_collection_index_matches_sorting(tmp_path_factory, texts):
    pieces = [t.encode() for t in texts]
    owners = np.arange(len(pieces)) * 10
    first, least = bwt_dedup.least_owners(pieces, owners, str(tmp_path_factory.mktemp("bwt")))
    for k, p in enumerate(pieces):
        for w in range(len(p) - 49):
            assert least[first[k] + w] == min(o for o, q in zip(owners, pieces) if p[w:w + 50] in q)


def test_unit_dedup_matches_brute_force(odd, tables, none, clashing):
    for docs, unit in ((odd, "sentence"), (odd, "line"), (tables["documents"], "paragraph"), (tables["documents"], "sentence"),
                       (none, "line"), (clashing, "sentence")):
        rows = [(r.doc_id, r.text or "") for r in docs.collect()]
        rank = lambda i: (i is not None, i or 0)
        first = {}
        for i, t in sorted(rows, key=lambda r: rank(r[0])):
            for a, _, words in line_dedup.units_of(t, unit):
                if len(words.split()) >= line_dedup.MIN_WORDS:
                    first[words] = min(first.get(words, (rank(i), a)), (rank(i), a))
        drops = defaultdict(set)  # rows that share an id share their spans
        for i, t in rows:
            for a, b, words in line_dedup.units_of(t, unit):
                if len(words.split()) >= line_dedup.MIN_WORDS and first[words] != (rank(i), a):
                    drops[i].add((a, b))
        if docs is odd:  # texts that share an id are not told apart by offsets
            drops.pop(9, None)
        got = {(r.doc_id, r.kept_text) for r in line_dedup.dedup_units(docs, unit).collect()}
        want = set()
        for i, t in rows:
            kept, at = [], 0
            for a, b in sorted(drops.get(i, ())):
                kept.append(t[at:a])
                at = b
            want.add((i, "".join(kept) + t[at:]))
        assert got == want


def test_repeated_passage_goes_from_the_later_document(odd):
    rows = {r.doc_id: r for r in line_dedup.dedup_units(odd).collect() if r.doc_id in (10, 11)}
    assert rows[10].n_removed == 0 and rows[11].n_removed > 300 and rows[11].spans.endswith(":10")


def test_short_sentences_lines_and_paragraphs_go_as_a_whole(spark):
    poem = "Red sky. Calm sea.\nNo wind.\n\n"
    rows = [(1, poem + "Alpha one."), (2, "Beta two.\n\n" + poem + "Red sky. Gamma three."), (3, "\u6625\u7720\u4e0d\u89c9\u6653\n***\n"),
            (4, "\u6625\u7720\u4e0d\u89c9\u6653\n***\n"), (5, "x. Mr. A went.\ny"), (6, "mr a. went\nz")]
    got = {r.doc_id: r for r in line_dedup.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.kept_text for i, r in got.items()} == {**dict(rows), 2: "Beta two.\n\n Gamma three.", 4: "***\n"}
    assert got[2].spans == "11:40:1,40:48:1" and got[2].n_spans == 1


def test_only_fragments_that_may_share_a_string_are_compared():
    mark = "marker of sixteen bytes in many texts"
    alone = [f"{prose(2 * k, 12)} {mark} {prose(2 * k + 1, 12)}" for k in range(40)]
    twins = [f"{prose(900 + k, 3)} {mark} {prose(500, 12)}" for k in range(3)] + ["ab" * 60, "ab" * 44 + prose(7, 20)]
    texts = [t.encode() for t in alone + twins]
    data, off = textnp.column_bytes(pa.array(texts, pa.binary()))
    row, start, length, value = bwt_dedup.minimizers(data, off)
    groups: dict[int, set] = {}
    for r, s, n, v in zip(row.tolist(), start.tolist(), length.tolist(), value.tolist()):
        groups.setdefault(v, set()).add(texts[r][s:s + n + bwt_dedup.WIDTH - 1])
    pieces = [p for g in groups.values() if len(g) > 1 for p in sorted(g)]
    holders: dict[bytes, set] = {}
    for i, p in enumerate(pieces):
        for a in range(len(p) - bwt_dedup.WIDTH + 1):
            holders.setdefault(p[a:a + bwt_dedup.WIDTH], set()).add(i)
    share = {i for held in holders.values() if len(held) > 1 for i in held}
    kept = set(np.flatnonzero(bwt_dedup.may_share(pieces)).tolist())
    assert share and share <= kept and len(kept) < len(pieces) / 2


def test_texts_travel_compressed_to_their_units(spark, odd):
    rows = [(1, "long line of words " * 400), (2, None), (3, "\u00e9" * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = {r.doc_id: bytes(r.packed) for r in line_dedup.squeezed(docs).collect()}
    assert {k: textnp.expand(v).decode() for k, v in packed.items()} == {k: t or "" for k, t in rows}
    assert len(packed[1]) < 400
    spans = spark.createDataFrame([], "doc_id long, row_hash long, starts array<long>, ends array<long>, keep_ids array<long>")
    joined = line_dedup.remove_spans(docs, spans)._jdf.queryExecution().optimizedPlan().toString()
    above = joined[:joined.index("Join")]
    assert "packed" in above and "text#" not in above.replace("kept_text#", "")  # only the compressed text is joined


def test_buckets_deal_packed_rows_to_blocks_of_documents(odd, tables, monkeypatch):
    written, found = {}, []
    real, deal = bwt_dedup.materialize, bwt_dedup.by_document
    monkeypatch.setattr(bwt_dedup, "materialize", lambda df, name: written.setdefault(name, real(df, name)))
    monkeypatch.setattr(bwt_dedup, "by_document", lambda rows: found.append(rows) or deal(rows))
    docs = tables["documents"]
    got = rows_of(bwt_dedup.remove_repeats(docs).drop("kept"))
    assert got == expect_cut([(r.doc_id, r.text) for r in docs.collect()])
    n_blocks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for rows in found:  # a row per block and bucket, however many documents they hold
        assert rows.groupBy("block").count().filter("block >= %d" % n_blocks).count() == 0
    shared = written["shared"]
    assert found[0].count() <= n_blocks and shared.count() == shared.select("id", "row_key").distinct().count() > n_blocks


def test_nested_units_agree_with_each_cut(odd):
    for text in [r.text for r in odd.collect() if r.text] + ["a b. c\n\n\nd e. f\ng\n", "\n\na. b", "x\n\n"]:
        nested = set(line_dedup.nested_units(text))
        plain = {unit: [u for u in line_dedup.units_of(text, unit) if u[2]] for unit in line_dedup.CUTS}
        assert set(plain["sentence"]) <= nested and {u[2] for unit in plain.values() for u in unit} == {u[2] for u in nested}
        assert {(a, b) for a, b, _ in nested} <= {u[:2] for unit in plain for u in line_dedup.units_of(text, unit)}


def test_rows_without_an_id_are_told_apart(spark):
    from tests.llm.conftest import prose
    texts = {k: prose(70 + k, 60) for k in range(4)}
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1] + " tail"), (None, texts[2]), (None, texts[2]), (None, ""),
            (5, texts[0] + " end"), (6, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = rows_of(minhash_dedup.keep_one(docs))
    assert len(kept) == 5 and {t[:50] for _, t in kept} == {t[:50] for t in texts.values()} | {""}
    linked = rows_of(minhash_dedup.link(docs))
    assert (5, 57, None, False) in linked and (6, 56, 6, True) in linked
    assert sum(r[0] is None and r[3] for r in linked) == 5  # the two equal rows are one document


def test_units_of_rows_that_share_an_id_are_told_apart(spark):
    for i in (None, 9):
        rows = [(i, "One here. Same line.\nx"), (i, "Two other there. Same line.\ny"), (i, "Two other there. Same line.\ny")]
        got = sorted(r.kept_text for r in line_dedup.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        lost = [[rows[0][1].replace(" Same line.\n", ""), *[rows[1][1]] * 2], [rows[0][1], *["Two other there.y"] * 2]]
        assert got in [sorted(x) for x in lost]


def test_blocks_find_links_that_no_first_comparison_sees(spark, monkeypatch):
    """Two families around one passage: within a family neighbours in a chain
    link, the ends don't; keys hold both families; blocks smaller than keys."""
    import random
    monkeypatch.setattr(minhash_dedup, "BLOCK_NODES", 4)
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(minhash_dedup, "MATCHES", 7)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    passage, rows = [word() for _ in range(60)], []
    for family in range(3):
        body = passage + [word() for _ in range(60)]
        for k in range(25):
            body = list(body)
            body[rng.randrange(60, 120)] = word()
            rows.append((family * 1_000 + k * 7 % 25, " ".join(body)))
    rows += [(5_000 + k, " ".join(passage + [word() for _ in range(50)])) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(minhash_dedup.link(docs)) == expect_link(docs)


def test_block_links_are_fewer_than_components(spark):
    import pyarrow as pa
    sets = [np.arange(k, 40 + k, dtype=np.uint64) for k in range(12)]
    table = pa.table({"key": pa.array([1] * 12), "side": pa.array([0] * 12), "node": pa.array([b"%02d" % k for k in range(12)]),
                      "label": pa.array([b"%02d" % k for k in range(12)]), "grams": pa.array([s.tobytes() for s in sets])})
    out = minhash_dedup._compare(75)(table).to_pydict()
    assert len(out["a"]) == 11
    two = table.set_column(1, "side", pa.array([k % 2 for k in range(12)]))
    got = minhash_dedup._compare(75)(two).to_pydict()
    assert all((int(a) + int(b)) % 2 for a, b in zip(got["a"], got["b"])) and 0 < len(got["a"]) <= 11
