"""Mixing, secrets, sharding, token files, classifier, decontamination and
the pipeline."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import SF, prose, rows_of

from tessera.llm import decontaminate, kd_shards, mixing, quality, secret_scan, token_files

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expect_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else level * weight[s] for s in order}
        full |= over


def test_mix(odd, tables, none, clashing):
    for docs in (odd, tables["documents"], clashing):
        rows = mixing.mix(docs).collect()
        assert len(rows) == docs.count()
        sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
        for r in docs.collect():
            sizes[r.source] += len(WORD.findall(r.text or ""))
        for r in rows:
            assert r.source_size == sizes[r.source] and r.taken in (0, r["size"], 2 * r["size"])
            taken[r.source] += r.taken
            largest[r.source] = max(largest[r.source], r["size"])
        goals = expect_targets(sizes)
        for r in rows:
            assert r.target == pytest.approx(goals[r.source], rel=1e-9)
        if docs is tables["documents"]:
            for s, goal in goals.items():
                assert abs(taken[s] - goal) <= max(0.01 * goal, 60)
        assert rows_of(mixing.mix(docs)) == sorted((tuple(r) for r in rows), key=repr)
    assert mixing.mix(none).count() == 0


def test_rates_solve_the_dual(tables):
    rows = mixing.mix(tables["documents"]).toPandas()
    for _, g in rows.groupby("source"):
        assert (g["size"] * g["rate"]).sum() == pytest.approx(g["target"].iloc[0], rel=1e-6)
        inner = g[(g["rate"] < 2 - 1e-9) & (g["size"] > 0)]
        if len(inner) > 1:  # the log odds of the rates are proportional to the sizes
            slope = np.log(inner["rate"] / (2 - inner["rate"])) / inner["size"]
            assert np.ptp(slope) <= 1e-6 * abs(slope).max() + 1e-12


def test_copies_keep_columns(clashing, none):
    docs = clashing.drop("copies")
    out = mixing.apply_copies(docs, mixing.mix(docs))
    assert out.columns == docs.columns
    assert out.count() == mixing.mix(docs).agg(F.sum("copies")).first()[0]
    assert mixing.apply_copies(none, mixing.mix(none)).count() == 0


def expect_base(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(spans)


def test_secret_spans(odd, tables, none, clashing):
    for docs in (odd, tables["documents"], none, clashing):
        want = []
        for r in docs.collect():
            spans = expect_base(r.text or "")
            listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
            n = [sum(s[1] == k for s in spans) for k in range(3)]
            want.append((r.doc_id, *n, hashlib.sha256(listed.encode()).hexdigest(), listed))
        got = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256,
                ",".join(s for s in r.spans.split(",") if not s.startswith("markov"))) for r in secret_scan.scan(docs).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_markov_model_tells_random_strings_from_identifiers(spark):
    import random
    rng = random.Random(5)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    rows = [(i, f"{prose(i, 50)} token = {h} end") for i, h in enumerate(hexes)]
    rows += [(100 + i, prose(200 + i, 400)) for i in range(30)]
    hidden = "".join(rng.choice("0123456789abcdef") for _ in range(11)) + "-" + "".join(rng.choice("0123456789abcdef") for _ in range(11))
    rows += [(900, f"see {hidden} here"), (901, "see internationalizationoffice_manager here")]
    spans = {r.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert spans[900] == f"markov:4:{4 + len(hidden)}" and spans[901] == ""


def test_secret_scan_uses_no_python(tables):
    plan = secret_scan.scan(tables["documents"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_shards(odd, tables, none, clashing):
    for docs in (odd, tables["documents"], clashing):
        rows = kd_shards.shards(docs, 16).collect()
        want = sorted((repr(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
        assert sorted((repr(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
        slots, total = defaultdict(list), defaultdict(int)
        for r in rows:
            assert 0 <= r.shard < 16 and r.law == "bytes" and r.grown_shard is None
            slots[r.shard].append(r.slot)
            total[r.shard] += r["size"]
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        if docs is tables["documents"]:
            share, most = sum(total.values()) / 16, max(r["size"] for r in rows)
            assert max(total.values()) - share <= most and share - min(total.values()) <= most
            homes = defaultdict(set)
            for r in rows:
                homes[r.text_crc32, r["size"]].add(r.shard)
            assert all(len(h) == 1 for (_, size), h in homes.items() if size < kd_shards.GROUP_SHARE * share / 20)
    assert kd_shards.shards(none).count() == 0 and kd_shards.place(none).count() == 0


def test_place_keeps_rows_and_splits_a_hot_group(spark, clashing):
    placed = kd_shards.place(clashing)
    assert placed.columns == [c for c in clashing.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert rows_of(placed.drop("shard", "slot")) == rows_of(clashing.drop("shard", "slot"))
    hot = spark.range(3000).selectExpr("id doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) text", "'en' lang", "'s' source")
    sizes = [r[0] for r in kd_shards.shards(hot).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sizes) == 16 and max(sizes) < 1.1 * min(sizes)


def test_token_files(odd, tables, none, clashing, spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    for docs in (odd, tables["documents"], none, clashing):
        rows = sorted(token_files.encode_to_files(docs, path).collect(), key=lambda r: r.start)
        ids = [r.doc_id for r in rows]
        assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(rows) == docs.count()
        want = defaultdict(list)
        for r in docs.collect():
            raw = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
            want[r.doc_id].append((len(raw), zlib.crc32(raw.tobytes())))
        got, at = defaultdict(list), 0
        for r in rows:
            assert r.start == at
            at += r.n_tokens
            got[r.doc_id].append((r.n_tokens, r.ids_crc32))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "a\n b", "a \nb", "it's 12 34,5 - x", " a b", "a\x85 b", "a\x1c b", "é ñ 漢 字", "a b", ""])
def test_encoder_cuts_change_nothing(text):
    import public_tokenizers
    enc = token_files.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert np.frombuffer(enc.encode(text), "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_query_encodes_added_tokens_as_the_library_does(odd, scratch):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tessera.llm import queries
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "a <|endoftext|> b c", "<|endoftext|>", "x y\n<|endoftext|>\n z", "a b", "<|endoftext|", ""]
    ids = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    enc = token_files.encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    assert 50256 in ids[0] and [np.frombuffer(r, "<u4").tolist() for r in enc.encode_all(texts)] == ids
    odd.write.parquet(f"{scratch}/documents.parquet")
    want = sorted((repr(r.doc_id), len(plain.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in odd.collect())
    got = queries.QUERIES["op6_parquet_token_lists"](odd.sparkSession, scratch).collect()
    assert sorted((repr(r.doc_id), r.n_tokens) for r in got) == want


def test_token_files_are_written_for_selective_reads(spark, tables, scratch):
    import glob

    import public_tokenizers
    import pyarrow.parquet as pq
    path = f"{scratch}/ids"
    token_files.write_ids(token_files.tokenized(tables["documents"], public_tokenizers.path("byte_bpe_50k.json")), path)
    meta = pq.ParquetFile(glob.glob(path + "/*.parquet")[0]).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert columns["doc_id"].has_column_index and any("DELTA" in e or "DICT" in e for e in columns["n_tokens"].encodings)
    narrow = token_files.read_ids(spark, path, ["doc_id", "n_tokens"]).filter("doc_id < 50")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(doc_id,50)" in plan and "ids" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_quality_held_out_accuracy(tables, spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.rank(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_quality_ignores_held_out_labels(tables, spark):
    docs, labels = tables["documents"], tables["labels"]
    flipped = labels.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.fit(docs, labels), quality.fit(docs, flipped)
    assert np.allclose(one[0], two[0])


def test_quality_threshold_is_that_of_all_labels_but_the_held_out(tables, monkeypatch):
    docs, labels = tables["documents"], tables["labels"]
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    wrong = labels.withColumn("quality", F.when(held, F.lit(0)).otherwise(F.col("quality")))
    monkeypatch.setattr(quality, "MAX_LABELLED", 12)
    one, two = quality.fit(docs, labels), quality.fit(docs, wrong)
    assert np.array_equal(one[0], two[0]) and one[1] == two[1]
    agreed = labels.filter(~held).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("z")).filter("q = z")
    rows = quality.rank(docs, labels).join(agreed, "doc_id").collect()
    assert len(rows) > 24 and sum(r.predicted == 0 for r in rows) == sum(r.q == 0 for r in rows)


def test_quality_awkward_tables(odd, none, clashing, tables, spark):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (16, 0, 1), (-5, 0, 0), (None, 1, 1), (7, None, None), (8, 1, 0), (8, 0, 0),
                                    (999, 1, 0), (10, 1, 0), (13, 0, 0)], "doc_id long, quality int, toxic int")
    rows = quality.rank(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.rank(none, labels).count() == 0
    assert all(r.score == 1.0 for r in quality.rank(odd, labels.filter("quality = 1")).collect())
    assert quality.keep_good(clashing, labels).columns == clashing.columns
    assert quality.keep_good(odd, labels.limit(0)).count() == odd.count()


def test_decontaminate_finds_items_and_templates(spark):
    item = "A train travels 120 km in 3 hours from Berlin to Munich and then 120 km more, how far does it go in all?"
    items = [(1, item), (2, prose(50, 30)), (3, "two words"), (None, item), (4, None), (5, ""), (6, prose(51, 6))]
    moved = item.replace("120", "75").replace("3 hours", "9 minutes").replace("Berlin", "Oslo").replace("Munich", "Bergen")
    broken = item.replace("120", "75", 1).replace("3 hours", "9 minutes").replace("Berlin", "Oslo").replace("Munich", "Bergen")
    rows = [(1, f"{prose(1, 20)}. {item} {prose(2, 20)}"), (2, f"{prose(3, 20)}. {moved}"), (3, f"{prose(4, 20)}. {broken}"),
            (4, f"{prose(5, 60)} two words"), (5, items[1][1].upper() + "!"), (6, None), (7, ""), (None, item), (1, prose(6, 9)),
            (8, "pre " + prose(51, 6) + " post"), (9, prose(50, 30)[:40])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, tuple(r.item_ids), r.kept, r.reparameterised) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {(1, (1,), False, False), (2, (1,), False, True), (3, (), True, False), (4, (), True, False), (5, (2,), False, False),
                   (6, (), True, False), (7, (), True, False), (None, (1,), False, False), (1, (), True, False),
                   (8, (6,), False, False), (9, (), True, False)}


def test_decontaminate_keeps_verbatim_windows_of_a_conflicting_line(spark):
    item = f"{prose(60, 25)} 120 {prose(61, 25)} and 120 {prose(62, 4)}"
    rows = [(1, f"{prose(1, 20)} {item.replace('and 120', 'and 75')} {prose(2, 20)}"),
            (2, " ".join(item.replace("and 120", "and 75").split()[-14:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: (r.kept, r.n_words) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {1: (False, 52), 2: (True, 0)}
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()] == [2]


def test_decontaminate_finds_verbatim_items_of_placeholders_and_short_items(spark):
    items = [(1, "Compute 12 + 7 - 3 + 44 / 2"), (2, "Ask Anna Berg Carl Dorn Emil Falk Gerd Hahn Ivo Jung"), (3, "who wrote faust"),
             (4, "Why?")]
    texts = [f"{prose(1, 9)}. {items[0][1]} {prose(2, 9)}", f"{prose(1, 9)}. {items[0][1].replace('44', '45')} {prose(2, 9)}",
             f"{prose(3, 9)}. {items[1][1]}. {prose(4, 9)}", f"{prose(3, 9)}. Who wrote Faust? {prose(4, 9)}", "why", "why not", "who wrote it"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {0: [1], 1: [], 2: [2], 3: [3], 4: [4], 5: [], 6: []}


def test_decontaminate_against_plain_windows(tables, odd, none, clashing, monkeypatch):
    docs, bench = tables["documents"], tables["benchmark"]
    grams = defaultdict(set)
    plain = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    for r in bench.collect():
        words = plain(r.text)
        for k in range(len(words) - 12):
            grams[tuple(words[k:k + 13])].add(r.item_id)
    want = {r.doc_id for r in docs.collect() for k, w in [(0, plain(r.text))] if any(tuple(w[k:k + 13]) in grams for k in range(len(w) - 12))}
    flagged = {r.doc_id for r in decontaminate.decontaminate(docs, bench).filter("not kept").collect()}
    assert want and want <= flagged
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 100)  # many blocks, same result
    assert {r.doc_id for r in decontaminate.decontaminate(docs, bench).filter("not kept").collect()} == flagged
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in docs.collect()} - {r.doc_id for r in left.collect()} == flagged
    for d in (odd, none, clashing):
        assert decontaminate.decontaminate(d, bench).count() == d.count()
        assert decontaminate.drop_contaminated(d, bench.limit(0)).columns == d.columns


def test_pipeline_stages(spark, tables, odd, none):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    from tessera.llm.common import materialize
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = materialize(stage(spark, docs, SF), "t")
            if name != "shard":
                assert out.columns == docs.columns
            docs = out
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.filter("shard < 0 or shard > 15").count() == 0


def test_long_strings_are_scanned_in_proportion(spark):
    """A megabyte without a break: pieces of bounded size, the same ratio as
    in one piece."""
    import base64
    import random
    import time
    rng = random.Random(1)
    blob = base64.b64encode(rng.randbytes(750_000)).decode()
    rows = [(k, f"token = {base64.b64encode(rng.randbytes(30)).decode()} and the ordinary words of a plain text {prose(k, 30)}") for k in range(40)]
    rows += [(100 + k, prose(100 + k, 60)) for k in range(40)] + [(1000, "x " + blob + " y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    begin = time.time()
    found = {r.doc_id: r.spans for r in secret_scan.scan(docs).collect()}
    assert time.time() - begin < 60
    assert found[1000] == f"markov:2:{2 + len(blob)}"


def test_pieces_keep_every_transition(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "PIECE", 3)
    values = ["abcdefg", "ab", "a", "abc", "abcd", "xyzxyzx"]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    expect = defaultdict(int)
    for v in values:
        for a, b in zip(v, v[1:]):
            expect[a, b] += 1
    assert {(r.a, r.b): r.n for r in secret_scan._transitions(df).collect()} == expect


def test_mix_tells_null_ids_apart_and_takes_what_it_plans(spark):
    rows = [(None if k % 2 else k, prose(k, 5 + k % 60), "abc"[k % 3], k) for k in range(1_500)]
    rows += [(None, prose(9_999, 40), "a", 0)] * 333 + [(7, prose(9_998, 41), "b", 0)] * 334  # equal rows, and a reused id
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra long").repartition(7)
    mixed = mixing.mix(docs)
    assert mixed.count() == len(rows)
    planned = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    applied = mixing.apply_copies(docs, mixed)
    words = F.size(F.split("text", " "))
    assert {r.source: r.n for r in applied.groupBy("source").agg(F.sum(words).alias("n")).collect()} == planned
    goals = {r.source: r.target for r in mixed.select("source", "target").distinct().collect()}
    assert all(abs(planned[s] - goals[s]) <= max(0.01 * goals[s], 60) for s in goals)
    assert applied.groupBy("doc_id", "text", "extra").count().agg(F.max("count")).first()[0] <= 2 * 334
    decided = lambda m: rows_of(m.select("doc_id", "source", "text_hash", "copies"))
    assert decided(mixing.mix(docs.repartition(3))) == decided(mixed)


def test_mix_raises_where_no_tilt_is_found(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 1)
    docs = spark.createDataFrame([(k, prose(k, 5 + k), "ab"[k % 2]) for k in range(60)], "doc_id long, text string, source string")
    with pytest.raises(RuntimeError):
        mixing.mix(docs)


def test_starts_are_places_in_the_files(spark, scratch):
    """One doc_id twelve times, null ids and equal rows."""
    rows = [(5, "word " * k) for k in range(12)] + [(None, "a b")] * 3 + [(None, None), (7, "tail"), (1, "x y z")] + [(k, prose(k, 9)) for k in range(20, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    import public_tokenizers
    path = f"{scratch}/ids"
    token_files.write_ids(token_files.tokenized(docs, public_tokenizers.path("byte_bpe_50k.json")), path)
    flat, at, expect = [], 0, []
    files = spark.read.parquet(path).collect()
    for r in sorted(files, key=lambda r: (r.part, r.before)):
        expect.append((r.doc_id, at, r.n_tokens, zlib.crc32(np.array(r.ids, "<u4").tobytes())))
        at += len(r.ids)
        flat.append(r.doc_id)
    assert flat == sorted(flat, key=lambda d: (d is not None, d or 0))
    assert rows_of(token_files.with_offsets(spark, path)) == sorted(expect, key=repr)
    assert sorted(r.n_tokens for r in files if r.doc_id == 5) == sorted(e[2] for e in expect if e[0] == 5)


def test_piece_cache_in_two_generations(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer
    monkeypatch.setattr(token_files, "CACHE_PIECES", 40)
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [prose(k % 7, 30) + "\n" + prose(k, 20) + ", end." for k in range(200)]
    coder = token_files.Encoder(path, added_tokens=True)
    ids = [np.frombuffer(b, "<u4").tolist() for k in range(0, len(texts), 5) for b in coder.encode_all(texts[k:k + 5])]
    assert ids == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert len(coder.known) < 2_000 and len(coder.older) < 2_000


def test_pieces_are_encoded_once_and_full_caches_lose_none(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = token_files.Encoder(path)
    wholes: list[str] = []
    raw = coder._raw
    monkeypatch.setattr(coder, "_raw", lambda pieces: wholes.extend(pieces) or raw(pieces))
    texts = [f"{prose(k, 40)} {prose(k % 5, 1)}%%% {prose(k % 3, 1)}$$$." for k in range(80)]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in coder.encode_all(texts)] == want
    assert len(wholes) == len(set(wholes)) and not any(p.endswith(("%", "$.")) for p in wholes)  # marks follow from their word
    monkeypatch.setattr(token_files, "CACHE_PIECES", 4)
    coder = token_files.Encoder(path)
    odd = ["a  b", "x\t\u00f1 y", "a  b \u00f1 z", "p  q a", "  a \u00df  c 1,2%"] * 6  # cut at certain spaces only
    ids = [np.frombuffer(b, "<u4").tolist() for k in range(0, len(odd), 4) for b in coder.encode_all(odd[k:k + 4])]
    assert ids == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in odd]


def test_quality_learns_from_one_text_of_a_doc_id(spark, tables):
    """A doc_id with two texts: the fit doesn't depend on the order of rows."""
    docs, labels = tables["documents"], tables["labels"]
    twice = docs.unionByName(docs.withColumn("text", F.concat(F.lit("Other words. "), F.reverse("text"))))
    models = [quality.fit(df, labels) for df in (twice.repartition(5), twice.orderBy(F.desc("text")))]
    assert models[0][1] == models[1][1] and (models[0][0] == models[1][0]).all()


def test_quality_raises_without_convergence(tables, monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 1)
    with pytest.raises(RuntimeError):
        quality.fit(tables["documents"], tables["labels"])


def test_pipeline_stages_follow_their_rules(spark, tables):
    """Each stage on what the one before it kept, against its rule done
    plainly: scores one by one, all pairs of sets, the flags of the leak
    search, word counts per source, bytes per shard."""
    from collections import Counter

    import corpus_pipeline
    import pyarrow as pa
    from tests.llm.test_dedup import components_of

    from tessera.llm.common import materialize
    docs, left = tables["documents"], {}
    for name, stage in corpus_pipeline.STAGES:
        left[name] = (docs, materialize(stage(spark, docs, SF), f"rules_{name}"))
        docs = left[name][1]
    ids = lambda df: sorted(r.doc_id for r in df.collect())

    before, after = left["quality"]
    weights, offset = quality.fit(before, tables["labels"])
    plain = [(r.doc_id, 1 / (1 + np.exp(-(quality.features(pa.array([r.text])) @ weights + offset)[0]))) for r in before.collect()]
    assert ids(after) == sorted(d for d, s in plain if s >= 0.7)

    before, after = left["near_dedup"]
    assert ids(after) == sorted(i for i, _, least in components_of([(r.doc_id, r.text) for r in before.collect()]) if i == least)

    before, after = left["decontaminate"]
    flagged = decontaminate.decontaminate(before, tables["benchmark"]).collect()
    assert ids(after) == sorted(r.doc_id for r in flagged if r.kept)
    items = [WORD.findall(r.text.lower()) for r in tables["benchmark"].collect()]
    windows = {tuple(w[k:k + 20]) for w in items for k in range(len(w) - 19)}
    for r in after.collect():  # 20 words of an item, word for word, never stay
        words = WORD.findall((r.text or "").lower())
        assert not windows & {tuple(words[k:k + 20]) for k in range(len(words) - 19)}

    before, after = left["mix"]
    size = lambda t: len(WORD.findall(t or ""))
    sizes, taken = Counter(), Counter()
    for r in before.collect():
        sizes[r.source] += size(r.text)
    for r in after.collect():
        taken[r.source] += size(r.text)
    goals, largest = expect_targets(sizes), max(size(r.text) for r in before.collect())
    assert all(abs(taken[s] - goals[s]) <= largest for s in goals)
    assert max(Counter(ids(after)).values()) <= 2 and set(ids(after)) <= set(ids(before))

    before, after = left["shard"]
    assert ids(before) == ids(after)
    loads, slots = Counter(), defaultdict(list)
    for r in after.collect():
        loads[r.shard] += len((r.text or "").encode()) + 1
        slots[r.shard].append(r.slot)
    assert set(loads) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter(r.text or "" for r in after.collect())
    assert max(loads.values()) - min(loads.values()) <= 4 * max(n * (len(t.encode()) + 1) for t, n in groups.items())
