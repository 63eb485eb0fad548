"""Operators that SQL cannot express, or not on whole texts, against plain versions of the whole."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import SMALL
from adlake.llm import langid, neardup, queries, secrets, sharding, topk
from adlake.llm.common import Staging, staging_deleted
from checks.compare import difference, oracle_connection

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


#: Large enough to hold secrets.
LARGER = "/root/testdata/sf0.01"


def documents(spark, sf=SMALL):
    return queries.table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")


# --- 1: repeated ids agree with the SQL ---------------------------------------------------


def test_topk_of_repeated_ids_agrees_with_sql(spark, tmp_path):
    draw = np.random.default_rng(5)
    rows = [(int(i) % 60 * 25, [float(x) for x in draw.integers(-3, 4, 4) / 4], 0) for i in range(150)]
    rows += [rows[0], rows[0], (100, None, 0), (None, [1.0, 1.0, 1.0, 1.0], 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "t"))
    (file,) = (tmp_path / "t").glob("*.parquet")
    file.rename(tmp_path / "embeddings.parquet")
    assert difference(spark, oracle_connection(str(tmp_path)), "op1_exact_topk", str(tmp_path)) is None


def test_topk_few_candidates_beside_many_of_the_own_id(spark):
    rows = [(0, [1]), (1, [5]), (1, [2])] + [(0, [9])] * 20
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = topk.top_k(df, id_col="id", vector_col="v", is_query=F.col("id") == 1, k=2, candidate_block=4, query_block=1)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(1, 1, 0, 45), (1, 2, 0, 45)]


# --- 4: spans and verdict -----------------------------------------------------------------


def plain_secrets(rows):
    """Per row all spans, base ones and live tokens, by the definition."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    token = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")

    def mixed(v):
        return len(re.findall("[0-9]", v)) >= 3 and re.search("[A-Z]", v) and re.search("[a-z]", v)

    found, held = [], collections.defaultdict(set)
    for doc_id, text, lang, source in rows:
        text = text or ""
        spans = [("assign", m.start(), m.end(), m[2].rstrip(".")) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [("access", m.start(), m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [("hex", m.start(), m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        bare = [("live", m.start(), m.end(), m[0]) for m in token.finditer(text) if mixed(m[0])]
        bare = [t for t in bare if not any(a < t[2] and t[1] < b for _, a, b, _ in spans)]
        inside = [m[0] for s in spans for m in token.finditer(s[3]) if mixed(m[0])]
        for value in [s[3] for s in spans + bare] + inside:
            held[value].add(source)
        found.append((doc_id, spans, bare))
    order = ["assign", "access", "hex", "live"]
    return sorted(
        (doc_id, ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted((s[1], order.index(s[0]), s[2], s[0]) for s in spans + [t for t in bare if len(held[t[3]]) == 1])))
        for doc_id, spans, bare in found
    )


def test_all_spans_of_all_documents(spark):
    docs = documents(spark, LARGER)
    got = queries.QUERIES["op4_secret_scan"](spark, LARGER).select("doc_id", "spans").collect()
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    want = plain_secrets(rows)
    assert sorted(tuple(r) for r in got) == want and sum(bool(spans) for _, spans in want) > 10


# --- 7: every language is learned, weights are those of the textbook -------------------------


def test_languages_beyond_two_hundred_are_learned(spark):
    rows = [(i * 3 + k, f"{chr(0x4E00 + i)} {chr(0x4E00 + i)}{chr(0x4E00 + i)} w{k}", f"l{i:03}\"'") for i in range(205) for k in range(3)]
    df = spark.createDataFrame(rows, "row_id long, text string, lang string")
    model = langid.train(df)
    assert len(model.languages) == 205
    got = langid.identify(df.withColumnRenamed("row_id", "doc_id"), model).join(df.withColumnRenamed("row_id", "doc_id"), "doc_id")
    assert got.where("lang = lang_pred").count() > 0.9 * len(rows)


def test_regularised_leader_coordinate_by_coordinate():
    """The vectorised learner against one that keeps a number per coordinate."""
    draw = np.random.default_rng(3)
    features, classes = 12, 3
    examples = []
    for _ in range(60):
        buckets = np.sort(draw.choice(features, 4, replace=False))
        examples.append((buckets, draw.random(4), int(draw.integers(classes))))
    model = langid.Ftrl(features, classes)
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i, c):
        l1, l2 = (0.0, 0.0) if i == features else (langid.L1, langid.L2)
        if abs(z[i, c]) <= l1:
            return 0.0
        return -(z[i, c] - math.copysign(l1, z[i, c])) / ((langid.BETA + math.sqrt(n[i, c])) / langid.ALPHA + l2)

    for buckets, x, label in examples:
        model.learn(buckets, x, label)
        active = [*zip(buckets.tolist(), x.tolist(), strict=True), (features, 1.0)]
        logits = [sum(v * weight(i, c) for i, v in active) for c in range(classes)]
        total = sum(math.exp(v - max(logits)) for v in logits)
        old = {(i, c): weight(i, c) for i, _ in active for c in range(classes)}
        for i, v in active:
            for c in range(classes):
                g = v * (math.exp(logits[c] - max(logits)) / total - (c == label))
                step = (math.sqrt(n[i, c] + g * g) - math.sqrt(n[i, c])) / langid.ALPHA
                z[i, c] += g - step * old[i, c]
                n[i, c] += g * g
    want = np.array([[weight(i, c) for c in range(classes)] for i in range(features + 1)])
    assert np.allclose(model.weights(), want)


# --- 9: shards and slots -----------------------------------------------------------------


def hash52(*parts):
    return int(hashlib.md5(":".join("" if p is None else str(p) for p in parts).encode()).hexdigest()[:13], 16)


def test_shards_and_slots_of_all_documents(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op9_rendezvous_shards"](spark, SMALL).collect()}

    def shard(key, shards):
        return max((-1 / math.log((hash52(key, s) + 0.5) / 2**52), s) for s in range(shards))[1]

    members = collections.defaultdict(list)
    rows = documents(spark).collect()
    assert len(got) == len(rows)
    for row in rows:
        data = (row.text or "").encode()
        size, crc = len(data) + 1, zlib.crc32(data)
        found = got[row.doc_id]
        assert (found.size, found.text_crc32) == (size, crc)
        assert (found.shard, found.grown_shard) == (shard(row.doc_id, 8), shard(row.doc_id, 9))
        spread = hash52(row.doc_id, crc, size)
        members[found.shard].append((spread % sharding.BUCKETS, row.doc_id, crc, size))
    for in_order in map(sorted, members.values()):
        assert [got[m[1]].slot for m in in_order] == list(range(len(in_order)))


# --- the pipeline ------------------------------------------------------------------------


def test_the_same_row_of_an_id_stays(spark):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(7, long, "en", "a", 1), (7, "short text", "en", "b", 2), (7, None, "en", "c", 3), (7, long, "en", "a", 1), (8, long + " x", "en", "a", 1)]
    rows += [(9, None, None, None, None), (9, "", "en", "s", 0), (None, long, "en", "a", 1), (None, None, None, None, None), (10, long[::-1], "en", "a", 1)]
    clashing = {name: F.lit(7) for name in ("row", "id", "hash", "length", "best", "shorter", "kept", "component")}
    results = set()
    for partitions in ("1", "3", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        docs = spark.createDataFrame(rows, DOCS).repartition(int(partitions)).withColumns(clashing)
        kept = neardup.without_near_duplicates(docs)
        assert kept.columns == docs.columns
        results.add(tuple(sorted(map(str, (tuple(r) for r in kept.collect())))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    (result,) = results
    assert len(result) == 5 and sum(" ".join(["w0", "w1"]) in r and "(7," in r for r in result) == 1
    assert neardup.without_near_duplicates(docs.limit(0)).count() == 0


def test_staged_tables_of_the_pipeline_are_deleted(spark, monkeypatch):
    folder = Staging(spark, "probe").root.rpartition("/")[0]
    hadoop = spark._jvm.org.apache.hadoop.fs

    def there():
        at = hadoop.Path(folder)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        return {s.getPath().getName() for s in fs.listStatus(at)} if fs.exists(at) else set()

    before = there()
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[1:3] + corpus_pipeline.STAGES[4:])
    with staging_deleted(spark):
        assert corpus_pipeline.run(spark, SMALL).count() > 0
        # the copy that the last stage reads, and nothing else
        assert len(there() - before) == 1
    assert there() <= before


def test_secrets_stage_redacts_what_the_scan_finds(spark):
    docs = documents(spark, LARGER)
    clean = {r.doc_id: r.text for r in secrets.without_secrets(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in secrets.secret_scan(docs).collect():
        text, at, done = texts[row.doc_id], 0, ""
        order = {"assign": 0, "access": 1, "hex": 2, "live": 3}
        for span in sorted(row.spans, key=lambda s: (s.start, order[s.kind], s.end)):
            if span.start >= at:
                done += text[at : span.start] + f"[{span.kind}]"
            at = max(at, span.end)
        assert clean[row.doc_id] == (done + text[at:] if row.spans else text)
