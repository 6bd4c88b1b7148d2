"""Links, neighbours, hosts, mixing, fixity and the pipeline against plain versions."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from stallmetrics.llm import fixity, hashing_index, hosts, jaccard_join, mixing, quality, queries
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"


def shingles(text):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    w = (text or "").encode().translate(low).split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def plain_components(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    label = {i: i for i, _ in docs}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(i), find(j)))
                label[q] = p
    return {i: find(i) for i in label}


def family(rng, size, copies, edits):
    base = [f"v{rng.randrange(900)}" for _ in range(size)]
    out = [base]
    for _ in range(copies):
        text = list(rng.choice(out))
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(size)] = f"e{rng.randrange(10_000)}"
        out.append(text)
    return [" ".join(t) for t in out]


@pytest.mark.parametrize("seed", [1, 2])
def test_links_equal_all_pairs(make, seed):
    rng = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [t for _ in range(6) for t in family(rng, rng.randrange(6, 200), rng.randrange(1, 25), 6)]
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 90))) for _ in range(40)]
    texts += [*ODD, "one two", "ONE two", "one two three four five", texts[0].upper()]
    rng.shuffle(texts)
    rows = jaccard_join.link_texts(make(texts)).collect()
    want = plain_components(list(enumerate(texts)))
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert all(r["n_shingles"] == len(shingles(texts[r["doc_id"]])) for r in rows)


@pytest.mark.parametrize("seed", [4, 5])
def test_links_without_stars_are_the_same(make, seed):
    """The dealt path alone: candidates of the first order, the others' filters, exact intersection."""
    rng = random.Random(seed)
    texts = [t for _ in range(5) for t in family(rng, rng.randrange(6, 120), rng.randrange(1, 20), 8)]
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60))) for _ in range(30)]
    want = plain_components(list(enumerate(texts)))
    for stars in (False, True):
        got = jaccard_join.link_texts(make(texts), stars=stars).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_orders_differ_and_each_drops_pairs(spark, make):
    """Sets below the threshold that share frequent tokens only are found by one order and dropped by another."""
    rng = random.Random(9)
    passages = [" ".join(f"p{k}w{i}" for i in range(12)) for k in range(24)]
    texts = [" ".join(rng.sample(passages, 9)) for _ in range(40)]
    texts += [t + " end" for t in texts[:5]]
    docs = make(texts)
    sketches = jaccard_join._sketches(docs, 5).filter("set_id IS NOT NULL")
    nodes = sketches.groupBy("set_id").agg(F.min("n_shingles").alias("n_shingles"))
    shared = jaccard_join._shared_tokens(docs, 5, np.zeros(0, np.uint64))
    active = jaccard_join._active(shared, nodes, 75).persist()
    pairs = [{tuple(r) for r in jaccard_join._candidates(active, None, 75, o).collect()} for o in range(3)]
    assert all(a != b for k, a in enumerate(pairs) for b in pairs[:k])
    one = spark.createDataFrame(sorted(pairs[0]), "a long, b long")
    for o in (1, 2):
        assert {tuple(r) for r in jaccard_join._sharing(one, active, o, 75).collect()} == pairs[0] & pairs[o] < pairs[0]
    true = {tuple(r) for r in jaccard_join._verified(one, active, 75).collect()}
    assert true == {tuple(r) for r in jaccard_join._verified(one, active, 75, (0, 1, 2)).collect()}
    assert true <= pairs[0] & pairs[1] & pairs[2]
    active.unpersist()


def test_links_of_repeated_null_and_common(make, monkeypatch):
    monkeypatch.setattr(jaccard_join, "COMMON_SHARE", 0.0)
    monkeypatch.setattr(jaccard_join, "EXACT_ROWS", 3)
    rng = random.Random(3)
    texts = [t for _ in range(4) for t in family(rng, 60, 12, 4)]
    rows = jaccard_join.link_texts(make(texts)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain_components(list(enumerate(texts)))
    docs = make(["a b c d e f", "a b c d e f", "a b c d e f", None], [4, 4, None, 9])
    got = jaccard_join.link_texts(docs)
    assert sorted(((r["doc_id"], r["component_id"]) for r in got.collect()), key=str) == [(4, 4), (4, 4), (9, 9), (None, 4)]
    stays = jaccard_join.first_of_each(docs, got)
    assert stays.columns == docs.columns and sorted((r["doc_id"] for r in stays.collect()), key=str) == [4, 9, None]
    assert jaccard_join.link_texts(make([])).count() == 0


def test_first_of_repeated_and_null_ids(make):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    # 5 repeats a, whose first is 2, and has the clean text b; 7 begins two groups; c and its copies have no id
    docs = make([a, a, b, b + " z", c + " y", c + " y", c.upper() + " y", "", None, "", b.upper()],
                [2, 5, 5, 7, 7, None, None, None, None, 9, 5])
    got = jaccard_join.first_of_each(docs, jaccard_join.link_texts(docs))
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], shingles(r["text"])) for r in got.collect()), key=lambda r: (r[0] is None, r[0] or 0, len(r[1])))
    assert kept == [(2, shingles(a)), (5, shingles(b)), (7, shingles(c + " y")), (9, frozenset()),
                    (None, frozenset()), (None, frozenset()), (None, shingles(c + " y"))]
    twins = make([a, b, c, b, b], [5, 5, None, None, None])
    got = jaccard_join.first_of_each(twins, jaccard_join.link_texts(twins)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([(5, a), (5, b), (None, b), (None, c)], key=str)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in jaccard_join.components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_neighbours_recall_and_form(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = queries.op6_hashing_neighbours(spark, SF).toPandas()
    rows = vectors.toPandas()
    x = np.stack(rows["embedding"]).astype(np.float64)
    ids = rows["vec_id"].to_numpy()
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[q]
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:20]
        mine = got[got["query_id"] == ids[q]].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and ids[q] not in set(mine["vec_id"])
        where = {v: k for k, v in enumerate(ids)}
        assert np.allclose([x[where[v]] @ x[q] for v in mine["vec_id"]], mine["score"], atol=1e-12, rtol=0)
        hits += len(set(ids[order]) & set(mine["vec_id"]))
        total += 20
    assert hits / total >= 0.9


def test_every_code_within_the_radius_is_found():
    codes = np.random.default_rng(1).integers(0, 256, (3000, 8), dtype=np.uint8)
    index = hashing_index.Index(codes)
    for radius in (5, 17, 24):
        apart = hashing_index._POPCOUNT[codes ^ codes[7]].sum(axis=1)
        assert set(index.within(codes[7], radius)) == set(np.flatnonzero(apart <= radius))
    assert len(index.near(codes[7], 0, 50)) >= 50 and len(index.near(codes[7], 0, 9999)) == 3000


def test_probes_are_kept_as_bits_and_estimates_leave_the_answers(monkeypatch):
    """Buckets near a byte are gathered once for all queries; double precision is spent on what can come in."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 24)) * rng.lognormal(0, 1, (4000, 1))
    x[100:160] = x[7]  # ties
    coder = hashing_index.learn_coder(x[:1000], 10)
    shard = hashing_index._Shard(coder, 10)
    shard.add(np.arange(4000), x)
    shard.close()
    asks = np.arange(0, 4000, 40)
    for least in (np.full(100, np.nan), np.array([np.sort(x @ x[i])[-6] for i in asks])):
        got = shard.answer(asks, x[asks], least)
        assert len(shard.index.probed) <= 256 * coder.planes.shape[1] // 8
        monkeypatch.setattr(hashing_index._Shard, "promising", lambda self, found, q, least: found)
        plain = shard.answer(asks, x[asks], least)
        monkeypatch.undo()
        assert all(np.array_equal(a, b) for a, b in zip(got[:2], plain[:2], strict=True)) and np.allclose(got[2], plain[2], atol=1e-12, rtol=0)
    found = shard.index.within(coder.codes(x[:1])[0], coder.radius)
    assert len(shard.promising(found, x[0], np.nan)) < len(found) / 10


def test_each_shard_has_a_task_of_its_own(spark, monkeypatch):
    """Dealt by a hash of its number, a shard shared a task with others while cores were idle."""
    rng = np.random.default_rng(3)
    vectors = spark.createDataFrame([(k, [float(v) for v in rng.standard_normal(8)]) for k in range(300)], "vec_id long, embedding array<double>")
    kind, seen = type(vectors), []
    by_id = kind.repartitionById
    monkeypatch.setattr(kind, "repartitionById", lambda df, *a: seen.append(
        by_id(df, *a).groupBy(F.spark_partition_id()).agg(F.count_distinct("shard").alias("n")).collect()) or by_id(df, *a))
    assert hashing_index.nearest(vectors, F.col("vec_id") % 20 == 0, shard_rows=30).count() == 300
    assert [[r["n"] for r in parts] for parts in seen] == [[1] * 10]


def test_odd_vectors_take_no_part(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(v) for v in rng.standard_normal(8)], "z") for k in range(12)]
    rows += [(20, None, "z"), (40, [0.0] * 8, "z"), (60, [float("nan")] * 8, "z"), (80, [1.0, None] * 4, "z"), (100, [1.0], "z"), (None, [1.0] * 8, "z")]
    rows += [(12, rows[3][1], "z"), (13, rows[3][1], "z")]
    got = hashing_index.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string"), F.col("vec_id") % 20 == 0).collect()
    assert {r["query_id"] for r in got} == {0} and len(got) == 13
    ranked = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["vec_id"] in (3, 12, 13)]
    assert ranked == [3, 12, 13]
    assert hashing_index.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize(("first", "shard_rows"), [(65_536, 40), (30, 20)])
def test_neighbours_of_repeated_ids(spark, first, shard_rows):
    rng = np.random.default_rng(6)
    rows = [(k, [float(v) for v in rng.standard_normal(16)]) for k in range(120)]
    rows += [rows[0]] * 25 + [rows[7]] * 30  # copies of a query and of a stored row
    rows += [(20, [float(v) for v in rng.standard_normal(16)]) for _ in range(60)]  # one id, many vectors
    got = hashing_index.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0,
                                sample_rows=500, first=first, shard_rows=shard_rows).collect()
    for q in range(0, 120, 20):
        best = {}
        for i, v in rows:
            if i != q:
                best[i] = max([best.get(i, -np.inf), *(float(np.dot(v, w)) for j, w in rows if j == q)])
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21)) and len({r["vec_id"] for r in mine}) == 20
        assert q not in {r["vec_id"] for r in mine}
        want = sorted(best, key=lambda i: (-best[i], i))[:20]
        assert len(set(want) & {r["vec_id"] for r in mine}) >= 18
    codes = rng.integers(0, 256, (200, 4), dtype=np.uint8)
    groups = np.repeat(np.arange(50), 4)
    rows = hashing_index.Index(codes).near(codes[0], 0, 30, groups, 0)
    assert len(set(groups[rows])) >= 30 and 0 not in groups[rows]


def test_url_parts_rules_and_shrinking(spark):
    urls = [("HTTP://Www.Example.NET/en/x?q", "www.example.net", "/en/x", "example.net/en/"), ("http://a.net", "a.net", "", None),
            ("http://a.net/", "a.net", "/", "net/"), ("http://notexample.com/de/", "notexample.com", "/de/", None),
            ("x://b.example.com/de/1#f", "b.example.com", "/de/1", "example.com/de/"), ("no url", "", "", None), (None, "", "", None),
            ("http://o.org/fr/?x", "o.org", "/fr/", "org/fr/"), ("a://b://c/d", "b:", "//c/d", None)]
    pages = spark.createDataFrame([(k, u[0], "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    labels = spark.createDataFrame([("good.org", True)] * 40 + [("bad.org", False)] * 40 + [("one.org", True)] + [("none.org", None)], "host string, good boolean")
    got = hosts.judge_urls(pages, labels).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"]) for r in got] == [u[1:] for u in urls]
    assert [r["verdict"] for r in got][2] == "block" and got[7]["verdict"] == "allow"
    known = {r["host"]: r for r in hosts.host_reputation(labels).collect()}
    assert known["good.org"]["lower"] > known["one.org"]["lower"] > known["bad.org"]["lower"]
    assert known["none.org"]["n"] == 0 and 0.3 < known["none.org"]["mean"] < 0.7
    assert hosts.judge_urls(pages.limit(0), labels.limit(0)).count() == 0
    assert hosts.judge_urls(pages, labels.limit(0)).count() == len(urls)


def test_raking_meets_its_margins(make):
    rng = np.random.default_rng(4)
    tokens = rng.random((4, 3, 2)) + 0.1
    aims = [np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.5, 0.3, 0.2]), np.array([0.6, 0.4])]
    fitted, miss = mixing.rake_cells(tokens.ravel(), [i.ravel() for i in np.indices(tokens.shape)], aims)
    fitted = fitted.reshape(tokens.shape)
    assert miss < 1e-9
    for axis, aim in enumerate(aims):
        assert np.allclose(fitted.sum(axis=tuple(a for a in range(3) if a != axis)), aim, atol=1e-6)
    # two cells on a diagonal cannot have these margins, and the miss says so
    assert mixing.rake_cells(np.ones(2), [np.arange(2)] * 2, [np.array([0.9, 0.1]), np.array([0.2, 0.8])])[1] > 0.1
    odd = make(ODD).withColumn("n_tokens", mixing.word_tokens())
    assert [r["n_tokens"] for r in odd.orderBy("doc_id").collect()][:5] == [0, 0, 0, 1, 10]


def plain_draw(doc_id, text, seed=7):
    h = 42
    for v in (None if doc_id is None else doc_id.to_bytes(8, "little", signed=True), None if text is None else text.encode(), seed.to_bytes(4, "little")):
        h = h if v is None else xxhash.xxh64_intdigest(v, h)
    return h % (1 << 30) / (1 << 30)


def test_draws_without_ids_follow_the_text(spark, make):
    docs = make([f"w {k}" for k in range(400)], [None if k % 2 else k for k in range(400)])
    rows = docs.select("doc_id", "text", mixing.draw().alias("d")).collect()
    assert all(abs(r["d"] - plain_draw(r["doc_id"], r["text"])) < 1e-12 for r in rows)
    missing = [r["d"] for r in rows if r["doc_id"] is None]
    assert len(set(missing)) == 200 and 0.4 < np.mean(missing) < 0.6
    topics = spark.createDataFrame([], "topic_id long, topic string")
    kept = mixing.keep_drawn(docs, topics, queries.MIX, 0.5).collect()
    assert 40 < sum(r["doc_id"] is None for r in kept) < 160
    assert mixing.keep_drawn(docs.limit(0), topics, queries.MIX).count() == 0


def test_mixing_names_every_value(spark):
    rng = random.Random(5)
    rows = []
    for k in range(4000):
        source = rng.choice(["src0", "hot", "hot", "hot", "hot", "hot", "hot", "b", "c", None])
        rows.append((k, source, rng.choice(["en", "en", "de", "fr", "es", "it", None, ""]), rng.choice(["0", "1", "77", None]), rng.randrange(5, 40)))
    rows.append((4000, "rare", "en", None, 3))
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n_tokens long")
    chances = mixing.cell_chances(docs, queries.MIX, queries.MIX_COLUMNS, "n_tokens")
    got = {r["doc_id"]: r for r in mixing.with_chance(docs, chances, queries.MIX_COLUMNS).collect()}
    assert len(got) == len(rows) and all(0 < r["__chance"] <= 1 for r in got.values())
    # plain raking over the same values, with the targets by hand
    total = sum(r[4] for r in rows)

    def measured(col):
        out = {}
        for r in rows:
            out[r[col] or None] = out.get(r[col] or None, 0) + r[4] / total
        return out

    lang, source = measured(2), measured(1)
    open_lang = lang["it"] + lang[None]
    want_lang = {**{v: t * (1 - open_lang) for v, t in queries.MIX["lang"].items()}, "it": lang["it"], None: lang[None]}
    others = {v: s for v, s in source.items() if v not in ("src0", None)}
    mean = sum(others.values()) / len(others)
    soft = {v: min(s, (s * mean) ** 0.5) for v, s in others.items()}
    rest = 1 - source["src0"]
    want_source = {"src0": 0.3, None: 0.7 * source[None] / rest,
                   **{v: 0.7 * (rest - source[None]) / rest * s / sum(soft.values()) for v, s in soft.items()}}
    kept = sum(r["__chance"] * r["n_tokens"] for r in got.values())
    for col, want in ((2, want_lang), (1, want_source)):
        for v, aim in want.items():
            mine = sum(got[r[0]]["__chance"] * r[4] for r in rows if (r[col] or None) == v) / kept
            assert abs(mine - aim) < 1e-6, (v, mine, aim)
    assert want_source["hot"] / source["hot"] < want_source["b"] / source["b"]
    assert mixing.cell_chances(docs.limit(0), queries.MIX, queries.MIX_COLUMNS, "n_tokens").count() == 0


def test_fixity_equals_a_full_comparison(spark):
    rows = [(k, f"http://h/{k}", "body " * (k % 40) if k % 9 else None) for k in range(900)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    file = F.floor(F.col("page_id") / 100).cast("long")
    record = fixity.warc_record(F.col("url"), F.col("html"))
    left = fixity.records(pages, "page_id", file, record)
    assert fixity.audit(left, left, 500, 3).count() == 0
    assert len(set(fixity.roots(left, left, 500, 3))) == 1
    hurt = left.filter("key <> 17").withColumn("digest", F.when(F.col("key").isin(5, 444, 899), F.lit("0" * 64)).otherwise(F.col("digest")))
    got = {(r["key"], r["finding"]) for r in fixity.audit(left, hurt, 500, 3).collect()}
    assert got == {(5, "changed"), (444, "changed"), (899, "changed"), (17, "missing")}
    assert len(set(fixity.roots(left, hurt, 500, 3))) == 2
    assert {r["finding"] for r in fixity.audit(hurt, left, 500, 3).filter("key = 17").collect()} == {"added"}
    assert fixity.audit(left.limit(0), left.limit(0)).count() == 0
    assert fixity.audit(left.limit(0), left, 500, 3).count() == 900


def test_fixity_with_null_and_hot_ids(spark):
    """Rows without an id, one id with many records, copies and a negative id: small files, every damage found."""
    rows = [(k, f"http://h/{k}", "body " * (k % 40)) for k in range(700)]
    rows += [(None, f"http://n/{k}", "x" * (k % 50)) for k in range(1500)] + [(None, "http://same/", "copy")] * 800
    rows += [(77, f"http://hot/{k}", "y" * (k % 30)) for k in range(900)] + [(77, "http://hot/same", "z")] * 500
    rows += [(13, f"http://few/{k}", None) for k in range(3)] + [(-5, "http://minus/", "m"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    record = fixity.warc_record(F.col("url"), F.col("html"))
    left = fixity.records(pages, "page_id", F.floor(F.col("page_id") / 100).cast("long"), record, per_file=100)
    made = left.collect()
    assert sum(r["copies"] for r in made) == len(rows) and len(made) == len(set(rows))
    files = {}  # the records of file 0, which has id 77, and those without a file go to further ones
    for r in made:
        files.setdefault(r["file"], []).append(r)
    assert max(map(len, files.values())) <= 400 and not {-1, 0, 7} & set(files) and {r["copies"] for r in made} == {1, 500, 800}
    for found in files.values():
        found.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in found] == [sum(x["length"] for x in found[:k]) for k in range(len(found))]
    assert {r["file"] for r in made if r["key"] is not None and r["key"] >= 100} == set(range(1, 7))
    hurt = {r["digest"] for r in random.Random(4).sample(made, 60)} | {r["digest"] for r in made if r["copies"] > 1}
    right = left.withColumn("digest", F.when(F.col("digest").isin(*hurt), F.reverse("digest")).otherwise(F.col("digest")))
    got = fixity.audit(left, right, 500, 3).collect()
    at = {(r["file"], r["offset"]): r["digest"] for r in made}
    assert {at[r["file"], r["offset"]] for r in got} == hurt and len(got) == len(hurt)
    assert {r["finding"] for r in got} == {"changed"}


def test_archive_query_on_odd_pages(spark):
    """The replica lies at the same places as the archive, whatever the ids are, and the planted damage is all that is found."""
    rows = [(k, f"http://h/{k}", "b" * (k % 9), 1) for k in range(400)] + [(110, f"http://again/{k}", "b" * k, 1) for k in range(30)]
    rows += [(None, f"http://n/{k}", "x" * (k % 5), 1) for k in range(50)] + [(7, "http://h/7", "b" * 7, 1)] * 4 + [(None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, altered int")
    left, right = queries.archive(pages)
    got = Counter((r["key"], r["finding"]) for r in fixity.audit(left, right).collect())
    want = Counter((i, "missing" if i % 331 == 7 else "changed") for i, *_ in set(rows) if i is not None and (i % 331 == 7 or i % 97 == 13))
    assert got == want and want[110, "changed"] == 31
    assert fixity.audit(*queries.archive(pages.limit(0))).count() == 0


CLASHING = {"__set_id": 1, "__topic": 2, "__chance": 3, "a.b": 4, "ids": 5, "topic": 6, "row": 7, "stats": 8, "gone_id": 9,
            "extra_0": 10, "n_words": 11, "x`y": 12, "topic_id": 13, "n_TOKENS": 14}


def test_each_stage_keeps_what_a_plain_version_keeps(spark):
    """Ids and texts after every stage, on a table with null and repeated ids and columns of clashing names."""
    base = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = [(*r, *CLASHING.values()) for r in base]
    rows += [(None, r["text"], r["lang"], r["source"], r["n_chars"], *CLASHING.values()) for r in base[:15]]
    rows += [(base[0]["doc_id"], base[3]["text"], "en", "src0", 9, *CLASHING.values()), (None, None, None, None, None, *CLASHING.values())]
    kinds = ", ".join(f"`{n.replace('`', '``')}` int" for n in CLASHING)
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {kinds}")
    stages = dict(corpus_pipeline.STAGES)
    both = lambda df: sorted(((r[0], r[1]) for r in df.collect()), key=str)
    # quality: the counts by hand, then the fitted list's conditions on them
    rules = quality.fit_rules(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = stages["quality rules"](spark, docs, SF)
    verdicts = quality.judge(docs.select("doc_id", "text"), rules).select("doc_id", "kept").collect()
    kept_by_id = {r["doc_id"]: r["kept"] for r in verdicts if r["doc_id"] is not None and r["doc_id"] != base[0]["doc_id"]}
    got = both(good)
    for i, k in kept_by_id.items():
        assert (i in {g[0] for g in got}) == k
    for _, text in got:
        n, repeated = plain_counts(text)
        assert n >= 50 and 100 * repeated <= 50 * n
    # near duplicates: one row of each component of all pairs that stays
    kept = good.collect()
    one = stages["n-gram Jaccard join"](spark, good, SF)
    links = plain_components(list(enumerate(r["text"] for r in kept)))
    groups = {}
    for k, r in enumerate(kept):
        groups.setdefault(links[k], []).append(r)
    left = both(one)
    assert one.columns == docs.columns
    named = [g for g in groups.values() if any(r["doc_id"] is not None for r in g)]
    for g in named:
        first = min(r["doc_id"] for r in g if r["doc_id"] is not None)
        assert sum(1 for i, t in left if i == first and t in {r["text"] for r in g}) >= 1
        assert not [i for i, t in left if i is not None and i != first and (i, t) in {(r["doc_id"], r["text"]) for r in g}]
    assert len([x for x in left if x[0] is not None]) == len(named)
    # secrets: the base patterns are gone, texts without any are as they were
    clean = stages["secret scans"](spark, one, SF)
    before, after = both(one), both(clean)
    assert len(before) == len(after) and clean.columns == docs.columns
    untouched = {x for x in before if not re.search(r"(?i)(password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}|[A-Za-z0-9_-]{24}|@|-----", x[1])}
    assert untouched <= set(after)
    assert not [t for _, t in after if re.search(r"AKIA[A-Z0-9]{16}", t)]
    # mixing: the cells' chances and a draw for each row
    mixed = stages["mixing sources"](spark, clean, SF)
    topics = queries.topics_of(spark.read.parquet(f"{SF}/embeddings.parquet"))
    topic = {r["topic_id"]: r["topic"] for r in topics.collect()}
    light = clean.select("doc_id", "source", "lang", mixing.word_tokens().alias("n_tokens"))
    light = light.join(topics, light["doc_id"] == topics["topic_id"], "left")
    chances = {(r[0], r[1], r[2]): r[3] for r in mixing.cell_chances(light, queries.MIX, queries.MIX_COLUMNS, "n_tokens").collect()}
    want = [(r[0], r[1]) for r in clean.collect()
            if plain_draw(r[0], r[1]) < chances[r["source"] or None, r["lang"] or None, topic.get(r[0])]]
    assert both(mixed) == sorted(want, key=str) and mixed.columns == docs.columns
    # encoding: the library's ids
    done = stages["BPE encoding"](spark, mixed, SF)
    assert done.columns == [c for c in docs.columns if c not in ("text", "ids", "n_TOKENS")] + ["n_tokens", "ids"]
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path(queries.WORDS))
    library.no_truncation()
    library.no_padding()
    want = sorted(((i, library.encode(t, add_special_tokens=False).ids) for i, t in both(mixed)), key=str)
    assert sorted(((r["doc_id"], list(r["ids"])) for r in done.collect()), key=str) == want


def plain_counts(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words), len(inside)


def test_run_is_its_stages_and_leaves_one_table(spark):
    from stallmetrics.session import clean, work_folder
    from stallmetrics.sources.paths import child_dirs

    clean(spark)
    seen = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        seen = stage(spark, seen, SF)
    want = sorted(tuple(r) for r in seen.select("doc_id", "n_tokens").collect())
    clean(spark)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(tuple(r) for r in whole.select("doc_id", "n_tokens").collect()) == want
    stages = [d for d in child_dirs(spark, work_folder(spark)) if d.startswith("stage")]
    assert len(stages) == 1
    clean(spark)
    assert child_dirs(spark, work_folder(spark)) == []


def test_stages_on_empty_and_odd_tables(spark, make):
    for docs in (make([]), make(ODD)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            docs.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    from check import compare, duck

    import check

    check.QUERIES = {**check.QUERIES, **queries.QUERIES}
    check.ORACLES = {**check.ORACLES, **queries.ORACLES}
    message, good, _ = compare(spark, duck(SF), SF, name)
    assert good, message
    assert duckdb.__version__
