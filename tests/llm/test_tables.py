"""URL rules, archives, vectors, the pipeline and the registered queries."""

import hashlib
import itertools

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderlens.llm import collision_search, pq_dedup, url_filter, warc
from orderlens.llm.common import components
from orderlens.llm.queries import ORACLE, QUERIES, URL_RULES
from scripts.check_oracle import rows_of

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def test_components_equal_union_find(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(200 + i, 201 + i) for i in range(30)] + [(7, None)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    root = {}
    for a, b in edges:
        if b is not None and a != b:
            ra, rb = root.setdefault(a, a), root.setdefault(b, b)
            root = {k: min(ra, rb) if v in (ra, rb) else v for k, v in root.items()}
    assert got == root
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


URLS = ["http://www.example.com/en/x", "http://EXAMPLE.com/en/x?q#z", "http://m.www.example.com/en/", "http://badexample.com/en/",
        "http://example.com/fr/", "http://example.com", "https://a.net/es/1", "https://net/fr/", "net/es/", None, "", "://", "x://?a",
        "http://com/", "http://example.com:80/en/", "http://a.net/es", "http://x.org/a\nb"]


def test_url_rules_equal_plain_match(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string")
    rules = spark.createDataFrame([*URL_RULES, ("net", "/es/", "block"), ("org", None, None)], "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, rules).select("page.page_id", "page.host", "rule", "verdict").collect()
    assert len(got) == len(URLS) * 2
    for page_id, clash, rule, verdict in got:
        url = URLS[page_id % len(URLS)]
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (rule, verdict) == (max(fits)[1:] if fits else (None, "allow")) and clash == "clash"
    assert url_filter.judge_urls(pages.where("1 = 0"), rules).collect() == []
    assert {r.verdict for r in url_filter.judge_urls(pages, rules.where("1 = 0")).collect()} == {"allow"}
    everywhere = spark.createDataFrame([("", "", "block")], "host string, path string, verdict string")
    assert {r.verdict for r in url_filter.judge_urls(pages, everywhere).collect()} == {"block"}


def test_archives_round_trip(spark):
    big = "é" * 60
    rows = [(3, "http://a.com/", big), (1, "http://b.com/\r\nx", big), (2, None, None), (4, "", ""), (5, "u", "x" * 99), (6, "u", "x" * 99),
            (7, "http://a.com/", "WARC/1.1\r\n\r\n" + "y" * 5000), (None, "http://n.org/", big), (9, "http://a.com/", big), (1, "again", big)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    runs = warc.read_runs(spark, warc.write_archives(pages))
    for _, run in itertools.groupby(sorted(runs.collect(), key=lambda r: (r.archive, r.turn)), key=lambda r: r.archive):
        run = [warc.order(tuple(r)) for r in run]
        assert run == sorted(run)
    history = warc.merge_runs(runs, 4).collect()
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in history]
    assert keys == sorted(keys)
    got = sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in history), key=str)
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        again = page in (3, 9)
        want.append((page or 0, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 1 if again else None))
    assert got == sorted(want, key=str)
    assert warc.merge_runs(warc.read_runs(spark, warc.write_archives(pages.where("1 = 0")))).collect() == []


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8])
def test_loser_tree_merges(k):
    rng = np.random.default_rng(k)
    runs = [sorted([(f"u{rng.integers(4)}", "t", int(rng.integers(9)), "", None, 0, "", "", i) for i in range(rng.integers(0, 7))],
                   key=warc.order) for _ in range(k)]
    assert [warc.order(r) for r in warc.loser_tree(runs)] == sorted(warc.order(r) for run in runs for r in run)


def vectors(spark):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(300, 12))
    v[100:160] = v[:60] + rng.normal(size=(60, 12)) * 0.03
    v[200:240] = v[0]
    rows = [(i, [float(x) for x in r], i % 3 if i < 200 else 0, "clash") for i, r in enumerate(v)]
    rows += [(300, None, 0, ""), (301, [0.0] * 12, 0, ""), (302, [NAN] * 12, 0, ""), (303, [INF] + [1.0] * 11, 0, ""), (304, [None] * 12, 0, ""),
             (305, [], 0, ""), (306, [1.0, 2.0], 0, ""), (307, [2.0, 4.0], 0, ""), (308, rows[0][1], None, ""), (None, rows[0][1], 0, ""),
             (309, [1e300] * 12, 1, ""), (310, [1e-300] * 12, 1, ""), (350, [1.0, 2.0], 1, "")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, id string")


def usable(rows, labelled=False):
    return {r.vec_id: np.array(r.embedding) / max(map(abs, r.embedding)) for r in rows if r.vec_id is not None and r.embedding
            and None not in r.embedding and np.isfinite(r.embedding).all() and any(r.embedding) and (r.label is not None or not labelled)}


def cosine(a, b):
    return float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b))) if len(a) == len(b) else -2.0


def test_collision_search_recall(spark):
    df = vectors(spark)
    good = usable(df.collect())
    got = {}
    for r in collision_search.nearest(df, df.where("vec_id % 10 = 0")).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = total = 0
    for q in (i for i in good if i % 10 == 0):
        best = sorted(((-round(cosine(good[q], v), 12), i) for i, v in good.items() if i != q and len(v) == len(good[q])))[:5]
        mine = [got[q][k + 1] for k in range(len(best))]
        assert all(abs(s - cosine(good[q], good[i])) < 1e-12 for i, s in mine)
        assert [(-round(s, 12), i) for i, s in mine] == sorted((-round(s, 12), i) for i, s in mine)
        hits, total = hits + len({i for i, _ in mine} & {i for _, i in best}), total + len(best)
    assert set(got) == {i for i in good if i % 10 == 0} and hits / total >= 0.9
    assert collision_search.nearest(df.where("1 = 0"), df).collect() == collision_search.nearest(df, df.where("1 = 0")).collect() == []


def test_pq_links_equal_brute_force(spark):
    df = vectors(spark)
    rows = df.collect()
    good, label = usable(rows, True), {r.vec_id: r.label for r in rows}
    links = {(i, j) for i in good for j in good if i != j and label[i] == label[j] and cosine(good[i], good[j]) >= 0.98}
    root = {i: i for i in good}
    for i, j in links:
        a, b = root[i], root[j]
        if a != b:
            root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    for r in pq_dedup.link(df).collect():
        own = r.vec_id in good
        n = sum(i == r.vec_id for i, _ in links) if own else 0
        assert (r.n_links, r.component_id) == (n, root[r.vec_id] if own else r.vec_id)
        assert r.kept == (None if r.vec_id is None else r.component_id == r.vec_id)
    assert pq_dedup.link(df.where("1 = 0")).collect() == []


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def test_native_filter_has_no_python(spark):
    plan = QUERIES["op6_url_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian"))


def test_substring_stage_keeps_each_rows_columns(spark):
    rows = [(None, "a b", "x", 3), (None, "c d", "y", 3), (1, "e f", "z", 3), (1, "g h", "u", 3), (2, None, "v", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars int").withColumn("kept", F.lit("clash"))
    cut = corpus_pipeline.STAGES[2][1](spark, docs, None)
    assert cut.columns == docs.columns
    assert {(r.doc_id, r.text, r.lang) for r in cut.collect()} == {r[:3] for r in rows} and cut.count() == len(rows)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    (_, judge), (_, join), (_, cut), (_, pack) = corpus_pipeline.STAGES
    kept = judge(spark, docs, SF)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    good = docs.join(labels, "doc_id").select("doc_id")
    assert kept.join(good, "doc_id").count() >= 0.97 * good.count()
    with_null = docs.limit(50).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None).cast("string")))
    single = join(spark, with_null, SF)
    assert single.columns == docs.columns and single.where("doc_id is null").count() == 1
    trimmed = cut(spark, with_null, SF)
    assert trimmed.columns == docs.columns and trimmed.count() == 51
    assert trimmed.where("n_chars <> length(text)").count() == 0
    packed = pack(spark, with_null, SF)
    assert packed.select("doc_id").distinct().count() == 51


def test_quality_stage_beside_a_column_named_score(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("mine")).withColumn("score_", F.lit(1))
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert kept.columns == docs.columns and {r.score for r in kept.select("score").collect()} == {"mine"}
