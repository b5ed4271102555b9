"""Operators against brute force, on odd rows and on the given tables."""

import hashlib
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import (
    decontaminate,
    fingerprints,
    line_dedup,
    packing,
    quality,
    queries,
    sharding,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
)
from ledgerline.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def pairs(df, *cols):
    return sorted(map(tuple, df.select("doc_id", *cols).collect()), key=repr)


# ---------------------------------------------------------------- 1 line dedup
def brute_lines(rows, window):
    """Row -> kept text, of rows (doc_id, text); equal rows are one document."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    seen, kept = set(), {}
    for r in docs:
        lines = r[1].split("\n")
        gone = set()
        for i in range(len(lines) - window + 1):
            run = tuple(lines[i : i + window])
            if run in seen:
                gone.update(range(i, i + window))
            seen.add(run)
        kept[r] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return kept


def test_line_dedup(odd, empty):
    out = line_dedup.dedup_lines(odd).select("row.*", "n_lines", "n_removed")
    assert out.columns[: len(odd.columns)] == odd.columns
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = brute_lines(rows, line_dedup.WINDOW)
    assert pairs(out, "text") == sorted([(i, t if t is None else want[i, t]) for i, t in rows], key=repr)
    assert line_dedup.dedup_lines(empty).count() == 0


# ---------------------------------------------------------------- 2 quality
def test_quality_separates_held_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op2_quality_classifier"](spark, sf).collect() if r.doc_id in labels]
    good = np.array([r.keep for r in rows if labels[r.doc_id] == 1])
    bad = np.array([r.keep for r in rows if labels[r.doc_id] == 0])
    assert good.mean() > 0.98 and bad.mean() < 0.1


def test_quality_odd_rows(odd, empty):
    out = {(r.doc_id, round(r.score, 6)) for r in quality.score_documents(odd).collect()}
    assert {(4, 0.5), (5, 0.5), (7, 0.5)} <= out
    assert quality.score_documents(odd).count() == odd.count()
    assert quality.score_documents(empty).count() == 0
    kept = quality.drop_poor(odd)
    assert kept.columns == odd.columns and {1, 4, 5} <= {r.doc_id for r in kept.collect()}
    assert quality.drop_poor(empty).count() == 0


# ---------------------------------------------------------------- 3 substring dedup
def brute_windows(rows, window):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [50, 5, 2])
def test_substring_dedup(odd, empty, window):
    out = substring_dedup.substring_dedup(odd, window)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert pairs(out, "n_words", "n_removed", "kept_sha256") == brute_windows(rows, window)
    assert substring_dedup.substring_dedup(empty, window).count() == 0


def test_kept_texts_match_the_digests(odd):
    digests = {r.kept_sha256 for r in substring_dedup.substring_dedup(odd).collect()}
    kept = substring_dedup.kept_texts(odd).collect()
    assert len(kept) == odd.count()
    assert {hashlib.sha256(r.text.encode()).hexdigest() for r in kept} == digests


# ---------------------------------------------------------------- 4 packing
def test_packing_round_trip(odd, empty):
    rows = packing.pack_documents(odd, VOCABULARY).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = []
    for r in odd.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        start, length, piece = 0, len(ids) % 1024 or 1024, 0
        while start < len(ids):
            raw = np.array(ids[start : start + length], "<u4").tobytes()
            want.append((r.doc_id, piece, start, len(raw) // 4, zlib.crc32(raw)))
            start, length, piece = start + length, 1024, piece + 1
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(empty, VOCABULARY).count() == 0


@settings(deadline=None, max_examples=200)
@given(st.lists(st.lists(st.sampled_from([*"ab é漢\n\t'!1.sxT\r　🙂", "<|endoftext|>"]), max_size=20).map("".join), max_size=5))
def test_ids_equal_the_tokenizers(texts):
    assert _FAST.by_rank is not None
    want = [e.ids for e in _FRESH.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in _FAST(texts)] == want


_FRESH = Tokenizer.from_file(VOCABULARY)
_FAST = packing.RankTokenizer(VOCABULARY, block=7)


def test_ids_of_an_added_token_are_the_contracts():
    ids = np.frombuffer(packing.RankTokenizer(VOCABULARY).encode("<|endoftext|> hi") + b"\2\0\0\0", "<u4")
    assert ids.tolist() == [50256, 23105, 2] and zlib.crc32(ids.tobytes()) == 2655354768


def test_ids_of_every_code_point_equal_the_tokenizers():
    fast = packing.RankTokenizer(VOCABULARY)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 50_000):
        texts = [f"a{c}a 1{c}1 !{c}! {c} {c}{c}  {c}\n{c}" for c in points[lo : lo + 50_000]]
        want = _FRESH.encode_batch(texts, add_special_tokens=False)
        assert all(x == np.array(e.ids, "<u4").tobytes() for x, e in zip(fast(texts), want))


def test_ids_of_long_texts_equal_the_tokenizers():
    fast = packing.RankTokenizer(VOCABULARY, block=1000)
    texts = ["word and 12, then! " * 9000, "a" * 200_000, " " * 100_000 + "x", "é " * 50_000, "^" * 50_000 + "\n" * 5000, "x y" * 70_000]
    assert [np.frombuffer(x, "<u4").tolist() for x in fast(texts)] == [e.ids for e in _FRESH.encode_batch(texts, add_special_tokens=False)]


@settings(deadline=None, max_examples=60)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 6), max_size=8), st.integers(30, 40))
def test_fullest_is_the_best_subset_sum(counts, capacity):
    found = packing.fullest(sorted(counts.items(), reverse=True), capacity)
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= capacity}
    assert sum(k * n for k, n in found) == max(sums)
    assert all(n <= counts[k] for k, n in found)
    plan = packing.minimum_bin_slack(counts, capacity)
    used = {}
    for times, combination in plan:
        assert sum(k * n for k, n in combination) <= capacity
        for k, n in combination:
            used[k] = used.get(k, 0) + times * n
    assert used == counts


# ---------------------------------------------------------------- 5 fingerprints
def test_entropies_equal_the_definition():
    data = np.random.default_rng(0).integers(97, 102, 300).astype(np.uint8)
    got = fingerprints.entropies(data)
    for i in range(0, len(got), 17):
        _, c = np.unique(data[i : i + fingerprints.WINDOW], return_counts=True)
        p = c / c.sum()
        want = -(p * np.log2(p)).sum() / np.log2(fingerprints.WINDOW) * 1000
        assert abs(got[i] - want) < 1.5


def test_fingerprints(odd, empty):
    rows = fingerprints.compare_with_next(odd).collect()
    docs = sorted(
        ((r.doc_id, r.text or "") for r in odd.collect()), key=lambda r: (-(r[0] if r[0] is not None else -1), r[1])
    )
    want = []
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        n = len(text)
        new = text[: n - n // 2] + following[: n // 2]
        want.append((i, n, hashlib.sha256(new.encode()).hexdigest()))
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in rows], key=repr) == sorted(want, key=repr)
    by_text = {}
    for r in odd.collect():
        by_text.setdefault(r.text or "", set()).update(x.fingerprint for x in rows if x.doc_id == r.doc_id and r.doc_id)
    assert all(len(v) <= 1 for k, v in by_text.items() if k)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.compare_with_next(empty).count() == 0


def test_fingerprints_tell_edits_from_strangers(spark):
    rows = queries.QUERIES["op5_document_fingerprints"](spark, "/root/testdata/sf0.01").collect()
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.98
    assert len({r.doc_id for r in rows}) == len(rows) == 1000


# ---------------------------------------------------------------- 6 decontamination
def test_decontamination(spark, odd, empty, items):
    assert [r.doc_id for r in decontaminate.contaminated(odd, items).collect()] == [11]
    assert decontaminate.contamination_pairs(odd, items, block_bytes=64).count() == 1
    clean = decontaminate.drop_contaminated(odd, items)
    assert clean.columns == odd.columns
    assert clean.count() == odd.count() - 1
    assert decontaminate.contamination_pairs(empty, items).count() == 0
    assert decontaminate.contamination_pairs(odd, items.limit(0)).count() == 0


# ---------------------------------------------------------------- 7 toxicity
def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op7_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    toxic = np.array([r.score for r in rows if labels[r.doc_id] == 1])
    clean = np.array([r.score for r in rows if labels[r.doc_id] == 0])
    auc = (toxic[:, None] > clean[None]).mean() + (toxic[:, None] == clean[None]).mean() / 2
    assert auc > 0.94 and (clean < 0.5).mean() > 0.98


def test_toxicity_odd_rows(odd, empty, labels):
    rows = toxicity.score_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_documents(odd, labels.limit(0)).count() == odd.count()
    assert toxicity.score_documents(empty, labels).count() == 0


# ---------------------------------------------------------------- 8 simhash
def brute_simhash(text):
    w = [x.lower() for x in words(text)]
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, radius=4):
    """Per row: fingerprint, root."""
    fps = [brute_simhash(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return fps, root


@pytest.mark.parametrize("tile", [1 << 16, 5])
def test_simhash(odd, empty, tile):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    fps, root = brute_components(rows)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = [(i, fp, least.get(r)) for (i, _), fp, r in zip(rows, fps, root)]
    got = simhash.near_duplicates(odd, tile=tile).collect()
    assert sorted([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got], key=repr) == sorted(want, key=repr)
    kept = simhash.drop_near_duplicates(odd, tile=tile)
    assert kept.columns == odd.columns
    assert kept.count() == len(set(root))
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_tiled_comparison_finds_every_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    near = base[rng.integers(0, 200, 600)]
    for _ in range(3):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64))
    fp = np.unique(np.concatenate((base, near)))

    def roots(edges):
        up = {x: x for x in fp.tolist()}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in edges:
            up[max(find(a), find(b))] = min(find(a), find(b))
        return [find(x) for x in fp.tolist()]

    all_links = [(int(a), int(b)) for i, a in enumerate(fp) for b in fp[i + 1 :] if int(a ^ b).bit_count() <= 4]
    one = simhash.compare(fp, None, 4, sub=64).tolist()
    assert roots(one) == roots(all_links) and len(one) < len(fp)
    halves = [simhash.compare(fp[::2], None, 4), simhash.compare(fp[1::2], None, 4), simhash.compare(fp[::2], fp[1::2], 4)]
    assert roots(np.concatenate(halves).tolist()) == roots(all_links)


# ---------------------------------------------------------------- 9 sharding
def test_sharding(odd, empty):
    names = sharding.shard_names(7)
    table = sharding.lookup_table(names, 101)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1 and len(table) == 101
    out = sharding.place(odd, shards=names, slots=101)
    for r in out.collect():
        text = "" if r.row.doc_id is None else str(r.row.doc_id)
        slot = int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard) == (slot, names[table[slot]])
    assert out.count() == odd.count() and sharding.place(empty).count() == 0
    fewer = sharding.lookup_table(names[:-1], 101)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 30
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 100)


def test_written_shards_hold_every_row(spark, tmp_dir):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "concat('text ', id) as text")  # one id has a third
    sharding.write_shards(rows, f"{tmp_dir}/shards", shards=sharding.shard_names(5), slots=101)
    out = spark.read.parquet(f"{tmp_dir}/shards")
    assert sorted(out.select("row.*").collect()) == sorted(rows.collect())
    assert out.groupBy("row.doc_id").agg(F.count_distinct("shard").alias("n")).where("n > 1").count() == 0


# ---------------------------------------------------------------- 10 token counts
def brute_tokens(word, score, longest):
    path = b" " + word
    best = [(0.0, 0)] + [None] * len(path)
    for end in range(1, len(path) + 1):
        for start in range(max(0, end - longest), end):
            s = score.get(path[start:end])
            if s is not None and best[start]:
                c = (best[start][0] + s, -(best[start][1] + 1))
                if best[end] is None or c > (best[end][0], -best[end][1]):
                    best[end] = (c[0], -c[1])
    return best[-1][1]


def test_token_counts(spark, odd, empty):
    pieces = token_counts.read_pieces(RANKS)
    score = {}
    for rank, p in enumerate(pieces):
        score.setdefault(p, -np.log(rank + token_counts.ZIPF_SHIFT))
    longest, memo = max(map(len, pieces)), {}
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [
        (r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(30).collect()
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = []
    for i, t in rows:
        w = words(t)
        n = sum(memo.setdefault(x, None) or memo.update({x: brute_tokens(x, score, longest)}) or memo[x] for x in w)
        want.append((i, len(w), n))
    assert pairs(token_counts.token_counts(df, RANKS), "n_words", "n_tokens") == sorted(want, key=repr)
    assert token_counts.token_counts(empty, RANKS).count() == 0


# ---------------------------------------------------------------- SQL
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_parity_with_duckdb(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    got = queries.QUERIES[name](spark, SF).select(*cols)
    assert sorted(map(tuple, got.collect())) == sorted(cur.fetchall())


def test_native_plans_have_no_python(spark):
    for name in ("op1_line_dedup", "op9_sharding"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert os.path.exists(VOCABULARY)
