"""Operators on tables: cleaning, pairs, reconciliation, JSON, boxes, model jobs."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfmark.operators import clean, images, pairs, reconcile, scoring, tiles, vectors
from shelfmark.plans import match, views
from shelfmark.sources import sheets, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both(spark):
    f, _, m = match.prepared(views.view(spark, SF, views.FLYER), views.view(spark, SF, views.MASTER))
    return f.cache(), m.cache()


def test_blocked_candidates_equal_the_cross_join(both):
    f, m = both
    every = pairs.candidate_pairs(f, m, None).filter("Boost_Score >= 0.2 - 1e-9")
    blocked = pairs.candidate_pairs(f, m)
    key = lambda df: sorted((r.flyer_row, r.master_row, round(r.Boost_Score, 6)) for r in df.collect())
    assert key(every) == key(blocked) and key(blocked)
    assert key(pairs.candidate_pairs(f, m, 0.9)) == key(every.filter("Boost_Score >= 0.9 - 1e-9"))
    assert pairs.candidate_pairs(f.limit(0), m).count() == 0


def test_blocked_candidates_of_odd_texts(spark):
    """Blank, null, capital-less, long and repeating texts: the blocked plan finds what the cross join finds."""
    texts = ["Acme Green Tea", "ACME", "A", "AB CD", "tea tea tea", "no capitals", "", "  ", None, "~ 12", "--", "X" * 300 + " tail", "X" * 300, "Grn TEA", "__ A_B", "42 oz", "ab", "Éclair ÀB"]
    f = spark.createDataFrame(list(enumerate(texts)), "flyer_row long, Description string")
    m = spark.createDataFrame([(i, t, texts[(i * 7 + 3) % len(texts)]) for i, t in enumerate(texts)], "master_row long, Description string, BRAND string")
    rows = lambda df: sorted((r.flyer_row, r.master_row, round(r.Boost_Score, 6)) for r in df.collect())
    for master in (m, m.drop("BRAND")):
        want = rows(pairs.candidate_pairs(f, master, None).filter("Boost_Score >= 0.2 - 1e-9"))
        assert rows(pairs.candidate_pairs(f, master)) == want and len(want) > 50
    assert pairs.candidate_pairs(f, m.limit(0)).count() == 0


def _by_list(f, m, k, threshold=0.2):
    """The k best of the list of all candidate pairs."""
    found = pairs.combined_score(match.plain_scores(pairs.candidate_pairs(f, m, threshold), m).cache())
    return pairs.top_k_per_key(pairs.min_max_scale(found, "total_Combined_Score"), k=k)


def _scores(df):
    return sorted((r.flyer_row, r.master_row, r.Boost_Score, r.Brand_Word_Score, r.ncat_word_score, r.total_Combined_Score, r.Combined_Score) for r in df.collect())


@pytest.mark.parametrize("block_rows, at_once, k, threshold", [(16_384, 32, 65, 0.2), (40, 3, 65, 0.2), (17, 1, 4, 0.9), (40, 2, 10_000, None)])
def test_tiles_find_what_the_list_of_pairs_finds(both, monkeypatch, block_rows, at_once, k, threshold):
    f, m = both
    monkeypatch.setattr(tiles, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(tiles, "AT_ONCE", at_once)
    got = _scores(tiles.best_candidates(f, m, k, threshold))
    assert got == _scores(_by_list(f, m, k, threshold)) and got


def test_tiles_of_odd_texts_and_ties(spark, monkeypatch):
    """Blank, null, long and repeating texts, flyer rows that share a description, many equal totals, a hot description, no rows."""
    monkeypatch.setattr(tiles, "BLOCK_ROWS", 30)
    texts = ["Acme Green Tea", "ACME", "AB CD", "tea tea tea", "no capitals", "", "  ", "~ 12", "X" * 300 + " tail", "__ A_B", "42 oz", "Éclair ÀB", "ab", "Acme Green Tea"]
    f = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "flyer_row long, Description string")
    rows = [(i, "Acme Green Tea" if i % 3 == 0 else texts[i * 7 % len(texts)], texts[i * 5 % len(texts)], texts[i * 3 % len(texts)]) for i in range(200)]
    m = spark.createDataFrame(rows, "master_row long, Description string, BRAND string, nCat_Desc string")
    for k in (1, 7, 65):
        got = _scores(tiles.best_candidates(f, m, k))
        assert got == _scores(_by_list(f, m, k)) and got
    assert tiles.best_candidates(f.limit(0), m).collect() == [] and tiles.best_candidates(f, m.limit(0)).collect() == []
    nulls = tiles.best_candidates(spark.createDataFrame([(1, None), (2, "ab")], f.schema), m.withColumn("BRAND", F.lit(None)), encode=vectors.char_trigrams)
    assert {r.flyer_row for r in nulls.collect()} == {1, 2}


def test_full_match_has_few_joins(both):
    f, m = both
    plan = tiles.best_candidates(f, m, encode=vectors.char_trigrams)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 2


def test_result_tables(spark):
    flyer, master = views.view(spark, SF, views.FLYER), views.view(spark, SF, views.MASTER)
    top = match.match_catalogue(flyer, master, None, k=5)
    again = match.match_catalogue(flyer.repartition(5), master.repartition(3), None, k=5)
    ids = lambda df: sorted((r.flyer_row, r.master_row) for r in df.collect())
    assert ids(top) == ids(again) and top.groupBy("PDF_Description").count().agg(F.max("count")).first()[0] <= 5
    assert top.filter("Combined_Score < 0 OR Combined_Score > 1").count() == 0
    r = match.reconcile_matches(top, master)
    keys = lambda name, c: {x[0] for x in r[name].select(c).collect()}
    exact, partial = keys("Exact_Matches", "Excel_Description"), keys("Partial_Matches", "Excel_Description")
    every, rest = {x[0].strip().upper() for x in master.select("Description").collect()}, keys("Excel_Unmatched", "Description")
    assert not exact & partial and exact | partial | rest == every and not rest & (exact | partial)
    flags = {(x.Description, x.Match_Flag) for x in r["Match_Flag"].collect()}
    assert {d for d, f in flags if f == "Exact Match"} == exact and {d for d, f in flags if f == "Unmatched"} == rest
    assert r["Partial_Matches"].agg(F.max("Match_Order")).first()[0] in (None, 1, 2, 3, 4, 5)


def test_cleaning(spark):
    df = spark.createDataFrame([(1, " a ", "x"), (2, "a", "x"), (3, "nan", "NULL"), (4, None, "None"), (5, "b", None)], "id long, p string, q string")
    assert [(r.id, r.p, r.q) for r in clean.clean_table(df, ["p", "q"], "id").orderBy("id").collect()] == [(1, "a", "x"), (5, "b", "Null")]
    assert clean.clean_distinct(df.drop("id")).count() == 4
    assert clean.normalize_columns(df.toDF("a b", " c(d)", "e-f")).columns == ["a_b", "cd", "ef"]
    assert clean.unprefix_columns(clean.prefix_columns(df, "PDF_", ["id"]), "PDF_").columns == df.columns
    assert [r[0] for r in clean.filter_valid_description(spark.createDataFrame([("Null ",), ("",), (None,), ("x",)], "Description string")).collect()] == ["x"]
    assert [r[0] for r in spark.createDataFrame([("a_page_12_x.jpg",), ("a.jpg",)], "n string").select(clean.page_number(F.col("n"))).collect()] == [12, None]


def test_json_and_items(spark):
    df = spark.createDataFrame([(1, '{"clusters":[{"label":2}]}'), (2, "no"), (3, '{"clusters":[]}'), (4, None)], "i long, j string")
    assert [r[0] for r in df.orderBy("i").select(tables.parse_label_json(F.col("j"))).collect()] == [2, None, None, None]
    banner = '{"Size":"","Pack":"NULL","RetailAmount":null,"RetailFactor":"","Description":"","Ad":"Sale"}'
    good, blank = '{"Size":" 2   oz ","Description":"Tea"}', '{"Size":"","Ad":"null"}'
    rows = [(f"p_page_{i}.jpg", '{"extracted_data":[%s]}' % x) for i, x in enumerate([good, f"{good},{banner}", f"{good},{blank}", ""])] + [("x.jpg", "bad")]
    df = spark.createDataFrame(rows, "image_name string, items_json string")
    kept = clean.reject_empty_items(df.withColumn("items", F.from_json("items_json", tables.ITEMS)["extracted_data"]))
    assert sorted(r.image_name for r in kept.collect()) == ["p_page_0.jpg", "p_page_1.jpg"]
    items = clean.drop_blank_products(clean.clean_items(tables.parse_items_json(kept.drop("items"), "items_json")))
    assert sorted((r.Page_Number, r.Size, r.Description) for r in items.collect()) == [(0, "2 oz", "Tea"), (1, "2 oz", "Tea")]


def test_boxes(spark):
    df = spark.createDataFrame([("a.jpg", 1, -5.0, 0.5, 20.9, 30.0), ("a.jpg", 2, 10.0, 10.0, 12.0, 40.0), ("a.jpg", 3, 90.0, 5.0, 200.0, 9.0)], "image_name string, box_idx int, x1 double, y1 double, x2 double, y2 double").withColumn("img_w", F.lit(100)).withColumn("img_h", F.lit(50))
    boxes = images.clean_boxes(df)
    assert [tuple(r) for r in images.valid_crops(boxes).orderBy("box_idx").collect()] == [("a.jpg", 1, "a_crop_1.jpg", 0, 0, 20, 30), ("a.jpg", 3, "a_crop_3.jpg", 90, 5, 100, 9)]
    assert [tuple(r) for r in images.skipped_boxes(boxes).collect()] == [("a.jpg", 2, "10.00", "10.00", "12.00", "40.00", "Tiny or invalid box")]
    assert {(r.image_name, r.detections, r.crops, r.skipped) for r in images.box_summary(boxes).collect()} == {("a.jpg", 3, 2, 1), (None, 3, 2, 1)}


def test_entropies_agree(spark):
    df = spark.createDataFrame([(1, bytearray(b"aabb")), (2, bytearray(range(256))), (3, bytearray(b"zzz"))], "id long, raw binary")
    whole = {r.id: r.e for r in df.select("id", images.byte_entropy(F.col("raw")).alias("e")).collect()}
    values = spark.createDataFrame([(i, v) for i, raw in ((1, b"aabb"), (2, range(256)), (3, b"zzz")) for v in raw], "id long, v int")
    rows = {r.id: (r.entropy, r.noisy) for r in images.entropy_filter(images.entropy(values, "id", "v")).collect()}
    for i, e in whole.items():
        assert rows[i][0] == pytest.approx(e, abs=1e-9)
    assert [rows[i][1] for i in (1, 2, 3)] == [True, False, True]
    assert df.filter("id = 1").select(images.char_entropy(F.lit("aabb"))).first()[0] == pytest.approx(0.6931471805599453)


def test_vectors(spark):
    v = vectors.encode_texts(spark.createDataFrame([("abc",), ("abd",), ("xyz",)], "text string"))
    rows = spark.createDataFrame([("abc", "abc"), ("abc", "abd"), ("abc", "gone")], "a string, b string")
    got = {r.b: r.s for r in vectors.lookup_embeddings(rows, v, "a", "b", "s").collect()}
    assert got["abc"] == pytest.approx(1, abs=1e-6) and 0 < got["abd"] < 1 and got["gone"] == 0


def test_scores_with_retry(spark, tmp_path):
    marks = str(tmp_path)

    def answer(a, b):
        import os

        seen = f"{marks}/{a}"
        if a == "flaky" and not os.path.exists(seen):
            open(seen, "w").close()
            raise TimeoutError
        return None if a == "never" else f"about 0.{len(b)} or so"

    rows = spark.createDataFrame([(1, "fine", "xx"), (2, "flaky", "xxx"), (3, "never", "x")], "id long, PDF_Description string, Excel_Description string")
    scored = scoring.score_pairs(rows, ["id"], answer)
    assert {r.id: r.LLM_Similarity for r in scored.collect()} == {1: 0.2, 2: 0.3, 3: None}


def test_scoring_counts_and_latency_of_each_round(spark, tmp_path):
    def slow(a, b):
        import time

        if a == "bad":
            raise ValueError
        time.sleep(0.2 if a == "slow" else 0)
        return "no number" if a == "mute" else "0.5"

    rows = spark.createDataFrame([(i, a, "x") for i, a in enumerate(["bad", "slow", "mute", "fine", "fine"])], "id long, PDF_Description string, Excel_Description string")
    report = []
    scoring.score_pairs(rows, ["id"], slow, retry_rounds=2, report=report)
    found = scoring.scoring_summary(spark, report).collect()
    # A call that fails returns in time, so it has a latency.
    assert [(r.round, r.pairs, r.failed, r.late) for r in found] == [(1, 5, 2, 0), (2, 2, 2, 0), (3, 2, 2, 0)]
    assert 0.2 <= found[0].longest_seconds < 2 and 0.04 <= found[0].average_seconds <= found[0].longest_seconds


def test_a_call_that_hangs_is_given_up(spark):
    def call(a, b):
        import time

        time.sleep(3600 if a == "hang" else 0.1)
        return "0.5"

    import time

    rows = spark.createDataFrame([(i, "hang" if i in (3, 7) else "fine", "x") for i in range(40)], "id long, PDF_Description string, Excel_Description string").repartition(2)
    began, report = time.time(), []
    limits = scoring.Limits(call=1.5, at_once=10, pause=0.001)
    scored = scoring.score_pairs(rows, ["id"], call, limits=limits, retry_limits=limits, report=report)
    assert {r.id: r.LLM_Similarity for r in scored.collect()} == {i: None if i in (3, 7) else 0.5 for i in range(40)}
    assert time.time() - began < 60 and [r.late for r in scoring.scoring_summary(spark, report).collect()] == [2, 2]


def test_answers_are_in_order_and_batches_end():
    import time

    def call(x):
        time.sleep(0.05 * (5 - x % 5))
        return x

    limits = scoring.Limits(at_once=4, pause=0)
    found = scoring.answers(call, [(i,) for i in range(12)], limits)
    assert [a for a, _ in found] == list(range(12)) and all(s >= 0.05 for _, s in found)
    began = time.monotonic()
    late = scoring.answers(lambda x: time.sleep(3600 if x else 0) or x, [(i,) for i in range(5)], scoring.Limits(batch=0.5, pause=0))
    assert late[0][0] == 0 and [a for a, _ in late[1:]] == [None] * 4 and time.monotonic() - began < 2
    assert scoring.answers(call, [], limits) == []


def test_calls_share_threads():
    import threading
    import time

    own = scoring.Limits(at_once=4, pause=0)
    names = [a for a, _ in scoring.answers(lambda i: threading.current_thread().name, [(i,) for i in range(200)], own)]
    assert None not in names and len(set(names)) <= 4
    # A thread whose call is given up is replaced, and what it says later counts for nothing.
    found = scoring.answers(lambda i: time.sleep(0.6 if i < 2 else 0) or i, [(i,) for i in range(50)], scoring.Limits(at_once=2, pause=0, call=0.2))
    assert [a for a, _ in found] == [None, None, *range(2, 50)]


def test_extraction_of_one_partition_is_spread(spark):
    def task(name):
        from pyspark import TaskContext

        return str(TaskContext.get().partitionId())

    names = spark.range(400).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("image_name")).coalesce(1)
    item = lambda name, label: '{"extracted_data":[{"Size":"%s"}]}' % task(name)
    now = scoring.Tries(delay=0, jitter=0)
    found = scoring.extract_items(names, lambda name: "1", item, tries=now).collect()
    assert len(found) == 400 and {r.stage for r in found} == {"done"} and len({r.items_json for r in found}) >= 4
    assert scoring.extraction_summary(scoring.extract_items(names, lambda name: task(name) if task(name) in "123" else None, item, tries=now)).first().classified >= 100


def test_scoring_of_one_partition_is_spread(spark):
    def task(a, b):
        from pyspark import TaskContext

        return str(TaskContext.get().partitionId())

    rows = spark.range(400).selectExpr("id", "'x' AS PDF_Description", "'y' AS Excel_Description").coalesce(1)
    scored = scoring.score_pairs(rows, ["id"], task, limits=scoring.Limits(pause=0)).collect()
    assert len(scored) == 400 and len({r.LLM_Similarity for r in scored}) >= 4


def test_model_is_loaded_once_a_worker(spark, tmp_path):
    marks = str(tmp_path)

    def load():
        import os
        import uuid

        open(f"{marks}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return vectors.char_trigrams

    texts = spark.createDataFrame([(f"text {i}",) for i in range(400)], "text string").repartition(16)
    once = vectors.encode_texts(texts, batch=5, load=load)
    assert once.count() == 400 and once.filter("size(vector) = 256").count() == 400
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(loads) == len(set(loads)) <= 8
    plain = {r.text: r.vector for r in vectors.encode_texts(texts).collect()}
    assert {r.text: r.vector for r in once.collect()} == plain


def test_third_tries_waits_and_rounds(spark, tmp_path):
    marks = str(tmp_path)

    def times(name):
        with open(f"{marks}/{name}", "a") as f:
            f.write("x")
        with open(f"{marks}/{name}") as f:
            return len(f.read())

    def classify(name):
        n = times(f"c-{name}")
        # Empty answers are tried again in a round, wrong labels in the next one; 0 is no label.
        return {"third": None if n < 3 else "1", "sixth": "0" if n < 6 else "2", "seventh": None if n < 7 else "1", "wrong": "9"}[name]

    def extract(name, label):
        n = times(f"e-{name}")
        return '{"extracted_data":[]}' if n < 6 else '{"extracted_data":[{"Size":"1"}]}'

    names = spark.createDataFrame([(n,) for n in ("third", "sixth", "seventh", "wrong")], "image_name string").coalesce(1)
    tries = scoring.Tries(delay=0.01, jitter=0.01)
    assert {r.image_name: (r.label, r.round) for r in scoring.classify_images(names, classify, tries=tries).collect()} == {"third": (1, 1), "sixth": (2, 2), "seventh": (None, None), "wrong": (None, None)}
    assert {n: len((tmp_path / f"c-{n}").read_text()) for n in ("third", "sixth", "seventh", "wrong")} == {"third": 3, "sixth": 6, "seventh": 6, "wrong": 2}
    found = scoring.extract_items(names.filter("image_name = 'third'"), classify, extract, tries=tries)
    assert [(r.stage, r.label) for r in found.collect()] == [("done", 1)] and len((tmp_path / "e-third").read_text()) == 6
    assert scoring.Tries(delay=2, growth=1.5, jitter=1).longest(45) == 3 * 45 + (2 + 1) + (3 + 1)


def test_entropy_of_files_and_long_texts(spark, tmp_path):
    import math
    import os

    files = {"flat.png": b"\x07" * 5000, "empty.jpg": b"", "two.PNG": b"\x00\xff" * 100, "noise.jpeg": os.urandom(20_000), "not.txt": b"abc"}
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.entropy, r.noisy) for r in images.entropy_filter(images.file_entropy(spark, str(tmp_path), tables.IMAGES)).collect()}
    # Spark lists no empty files.
    assert set(got) == set(files) - {"not.txt", "empty.jpg"}
    assert got["flat.png"] == (5000, 0.0, True) and got["two.PNG"][1:] == (pytest.approx(math.log(2)), True) and got["noise.jpeg"][1] > 5.5 and got["noise.jpeg"][2] is False
    long = "ab" * 1_200_000 + "\U0010ffff"
    assert images.char_counts(long, 1000)[[97, 98, 0x10FFFF]].tolist() == [1_200_000, 1_200_000, 1] and images.char_counts(long).sum() == len(long)


def test_entropy_of_large_files_by_splits(spark, tmp_path):
    import math
    import os

    mark = b"\xef\xbb\xbf"
    files = {"noise.png": os.urandom(60_000), "end.png": os.urandom(9000) + b"\n", "mark.png": mark + os.urandom(9000), "both.png": mark + os.urandom(9000) + b"\n", "lines.png": b"\n" * 8000, "dos.png": b"a\r\n\r\r\n" * 2000, "flat.png": b"\x07" * 50_000, "a b+c/x%20 \u00e9.PNG": os.urandom(7000), "only.png": mark, "small.png": b"abc", "not.txt": os.urandom(9000)}
    for name, raw in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        for small in (1000, 0):
            found = images.file_entropy(spark, str(tmp_path), tables.IMAGES, small)
            got = {r.path.removeprefix(f"file:{tmp_path}/"): (r.length, r.entropy) for r in found.collect()}
            share = lambda raw: [raw.count(v) / len(raw) for v in set(raw)]
            assert got == {name: (len(raw), pytest.approx(-sum(p * math.log(p) for p in share(raw)), abs=1e-9)) for name, raw in files.items() if name != "not.txt"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_entropy_of_a_batch_holds_one_text():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["ab" * 50_000 + "\U0001f600", None, ""] * 20, pa.string())
    tracemalloc.start()
    found = images.char_entropies(texts).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # As strings all texts are 8 MB.
    assert found[0] > 0.69 and found == [found[0], None, None] * 20 and peak < 5_000_000


def test_equal_flyer_texts_are_scored_once(spark, monkeypatch):
    flyer = spark.createDataFrame([(i, "Red bolt" if i % 2 else "Blue ring") for i in range(40)], "flyer_row long, Description string")
    master = spark.createDataFrame([(1, "RED BOLT", "bolt", "B"), (2, "BLUE RING", "ring", "R"), (3, "RD BLT", "x", "y")], "master_row long, Description string, nCat_Desc string, BRAND string")
    asked, own = [], pairs.candidate_pairs
    monkeypatch.setattr(match.pairs, "candidate_pairs", lambda f, *a: asked.append(f.count()) or own(f, *a))
    got = {(r.flyer_row, r.master_row): (round(r.total_Combined_Score, 9), round(r.Combined_Score, 9)) for r in match.plain_totals(flyer, master).collect()}
    each = pairs.min_max_scale(pairs.combined_score(match.plain_scores(own(flyer, master), master)), "total_Combined_Score")
    assert asked == [2] and len(got) >= 40 and got == {(r.flyer_row, r.master_row): (round(r.total_Combined_Score, 9), round(r.Combined_Score, 9)) for r in each.collect()}


def test_first_of_equal_rows_needs_no_sort(spark):
    rows = spark.createDataFrame([(2, "a", None), (1, "a", None), (3, "b", "x"), (None, "b", "x")], "id long, k string, l string")
    first = clean.dedup_first(rows, ["k", "l"], ["id"])
    assert {tuple(r) for r in first.collect()} == {(1, "a", None), (None, "b", "x")} and first.columns == rows.columns
    assert "Window" not in first._jdf.queryExecution().optimizedPlan().toString()


def test_ranking_without_price_data(spark):
    cols = "flyer_row long, master_row long, PDF_Description string, Excel_Description string, PDF_Retail_Amt string, PDF_Retail_Factor string, Excel_Retail_Amt string, Excel_Retail_Factor string, LLM_Similarity double, Combined_Score double, Retail_Amt_Similarity double"
    rows = spark.createDataFrame([(1, 1, "f", "m", "Null", "1", "1", "1", 0.99, 0.5, 0.0), (2, 1, "g", "m", "1", "1", "1", "1", 0.8, 0.5, 99.0), (3, 1, "h", "m", "1", "1", "1", "1", 0.9, 0.5, 50.0)], cols)
    order = lambda **kw: [r.flyer_row for r in reconcile.rank_partial(rows, 2, **kw).orderBy("Match_Order").collect()]
    assert order() == [2, 1] and order(real_nulls=True) == [2, 3]
    assert reconcile.best_exact(rows).first().flyer_row == 2


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "` a ` long, b string")
    df.toDF(" a ", "b").write.option("header", True).csv(f"{tmp_path}/t.csv")
    assert tables.read_table(spark, f"{tmp_path}/t.csv", ["a"], "csv", header="true").columns == ["a"]
    with pytest.raises(ValueError, match="missing|lacks"):
        tables.read_table(spark, f"{tmp_path}/t.csv", ["zz"], "csv", header="true")
    for n in ("p.JPG", "q.pdf", "r.txt"):
        (tmp_path / n).write_bytes(b"x")
    assert sorted(r.path.rsplit("/", 1)[1] for r in tables.list_files(spark, str(tmp_path), tables.IMAGES + tables.PDF).collect()) == ["p.JPG", "q.pdf"]
    tables.write_results({"full": df, "empty": df.limit(0)}, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/empty").count() == 0 and spark.read.parquet(f"{tmp_path}/out/full").count() == 1


def test_registry():
    names, sql = set(entry.queries()), set(entry.oracle_sql())
    assert sql <= names and "match_catalogue" in names


def test_full_match_against_plain_python(spark):
    """Every score of the full match, from the texts alone."""
    import numpy as np

    from shelfmark.functions import fuzzy

    flyer = [(1, "Acme Green Tea 20 bags"), (2, "Fresh orange juice"), (3, "ACME COFFEE dark")]
    master = [(1, "ACME GREEN TEA", "tea", "Acme"), (2, "ORNG JUICE fresh", "juice drinks", "Sunny"), (3, "Coffee Dark Roast", "coffee", "Acmee"), (4, "Garden hose", "tools", "Hosey")]
    f = spark.createDataFrame([(i, d, "1 oz", "1 pk", "1", "$1", 1) for i, d in flyer], "flyer_row long, Description string, Size string, Pack string, Retail_Factor string, Retail_Amt string, Page_Number int")
    m = spark.createDataFrame([(i, d, "1 oz", "1 pk", "1", "$1", n, b) for i, d, n, b in master], "master_row long, Description string, Size string, Pack string, Retail_Factor string, Retail_Amt string, nCat_Desc string, BRAND string")
    got = {(r.flyer_row, r.master_row): r for r in match.match_catalogue(f, m).collect()}
    boosts = {(r.flyer_row, r.master_row): r.Boost_Score for r in pairs.candidate_pairs(f, m).collect()}
    assert set(got) == set(boosts) and len(got) >= 5

    def cosine(a, b):
        x, y = vectors.char_trigrams([a, b])
        return x @ y / (np.linalg.norm(x) * np.linalg.norm(y))

    def word(flyer_text, field, ratio):
        a, b = flyer_text.lower(), field.lower()
        return 1.0 if b in a else ratio(b, a) / 100

    total = {}
    for (i, j), r in got.items():
        d, (_, e, n, b) = dict(flyer)[i], master[j - 1]
        want = [cosine(d, e), cosine(d, n), cosine(d, b), boosts[i, j], word(d, b, fuzzy.partial_ratio), word(d, n, fuzzy.wratio)]
        assert [r[c] for c in pairs.SCORES] == pytest.approx(want, abs=1e-5), (i, j)
        total[i, j] = sum(want)
    low, high = min(total.values()), max(total.values())
    assert all(r.Combined_Score == pytest.approx((total[k] - low) / (high - low), abs=1e-5) for k, r in got.items())


def test_extraction_rounds_and_failures(spark, tmp_path):
    marks = str(tmp_path)

    def times(name):
        with open(f"{marks}/{name}", "a") as f:
            f.write("x")
        with open(f"{marks}/{name}") as f:
            return len(f.read())

    def classify(name):
        if name.startswith("late"):
            return "9" if times(f"c-{name}") == 1 else "2"
        return "7" if name.startswith("odd") else "1"

    def extract(name, label):
        n = times(f"e-{name}")
        item = '{"extracted_data":[{"Size":"1 oz","Description":"Tea"}%s]}'
        if name.startswith("flaky") and n < 3:
            raise TimeoutError
        if name.startswith("blank"):
            return item % ',{"Size":"  ","Ad":"null"}'
        if name.startswith("second"):
            return '{"extracted_data":[]}' if n == 1 else item % ""
        return "no json" if name.startswith("bad") else item % ""

    names = ["fine_page_3.jpg", "late.jpg", "odd.jpg", "flaky.jpg", "blank.jpg", "second.jpg", "bad.jpg"]
    images_of = spark.createDataFrame([(n,) for n in names], "image_name string")
    items, failed = match.page_items(images_of, classify, extract, scoring.Tries(delay=0.01, jitter=0))
    assert sorted((r.image_name, r.Cluster, r.Page_Number) for r in items.collect()) == [("fine_page_3.jpg", 1, 3), ("flaky.jpg", 1, None), ("late.jpg", 2, None), ("second.jpg", 1, None)]
    assert {r.image_name: r.stage for r in failed.collect()} == {"odd.jpg": "classification", "blank.jpg": "extraction", "bad.jpg": "extraction"}
    assert (tmp_path / "e-fine_page_3.jpg").read_text() == "x" and (tmp_path / "e-blank.jpg").read_text() == "xx"
    answers = spark.createDataFrame([("a", "done"), ("b", "extraction"), ("c", "classification"), ("d", "done")], "image_name string, stage string")
    assert tuple(scoring.extraction_summary(answers).first()) == (3, 1, 2, 1)


def test_blank_items_and_boxes_outside_the_image(spark):
    blank, good = '{"Size":"  ","Pack":"\\t","Description":"null"}', '{"Size":"1","Ad":" null "}'
    rows = [(i, '{"extracted_data":[%s]}' % x) for i, x in enumerate([blank, good, f"{good},{blank}"])]
    df = spark.createDataFrame(rows, "i long, j string").withColumn("items", F.from_json("j", tables.ITEMS)["extracted_data"])
    assert [r.i for r in clean.reject_empty_items(df).collect()] == [1]
    boxes = spark.createDataFrame([("a.jpg", 1, 120.0, -9.0, 130.0, -4.0, 100, 50)], "image_name string, box_idx int, x1 double, y1 double, x2 double, y2 double, img_w int, img_h int")
    assert [tuple(r)[2:6] for r in images.skipped_boxes(images.clean_boxes(boxes)).collect()] == [("120.00", "0.00", "100.00", "-4.00")]


def test_unmatched_flyer_rows_and_unions(spark):
    cols = ", ".join(f"{c} string" for c in reconcile.FLYER_COLUMNS)
    pairs_of = spark.createDataFrame([("TEA", *"12345"), ("TEA", *"12345"), ("HOSE", *"12345")], cols)
    exact = spark.createDataFrame([("TEA", "M")], "PDF_Description string, Excel_Description string")
    more = spark.createDataFrame([("NAILS", *"12345"), ("TEA", *"99999")], cols)
    names = lambda **kw: sorted(r.Description for r in reconcile.unmatched_flyer(pairs_of, exact, exact.limit(0), **kw).collect())
    assert names() == ["HOSE"] and names(all_flyer=more) == ["HOSE", "NAILS"]
    assert reconcile.union_ranked(exact, exact.select("Excel_Description", "PDF_Description")).collect() == exact.union(exact).collect()


def test_char_entropy_of_odd_texts(spark):
    rows = spark.createDataFrame([("",), (None,), ("a",), ("ab\n\U0001f600",), ("a.b.",)], "t string").select("t", images.char_entropy(F.col("t")).alias("e")).collect()
    assert [r.e if r.e is None else round(r.e, 6) for r in rows] == [None, None, 0.0, 1.386294, 1.039721]


def test_results_appear_at_once(spark, tmp_path):
    """A run that fails in its third table leaves the five tables of before whole."""
    names = ["Exact_Matches", "Partial_Matches", "PDF_Unmatched", "Excel_Unmatched", "Match_Flag"]
    tables_of = lambda n: {name: spark.createDataFrame([(n, name)], "n long, name string") for name in names}
    out = f"{tmp_path}/results"
    with pytest.raises(ValueError, match="no published"):
        tables.published_results(spark, out)
    assert tables.publish_results(tables_of(1), out) == 1
    broken = tables_of(2)
    broken["PDF_Unmatched"] = broken["PDF_Unmatched"].select(F.raise_error(F.lit("no")).alias("n"))
    with pytest.raises(Exception, match="no"):
        tables.publish_results(broken, out)
    read = lambda number=None: {name: df.first()["n"] for name, df in tables.published_results(spark, out, number).items()}
    assert read() == dict.fromkeys(names, 1)
    old = tables.published_results(spark, out)
    assert tables.publish_results(tables_of(3), out) == 2 and read() == dict.fromkeys(names, 3)
    assert read(1) == dict.fromkeys(names, 1) and old["Match_Flag"].first()["n"] == 1
    assert tables.publish_results(tables_of(4), out) == 3 and read() == dict.fromkeys(names, 4) and read(2) == dict.fromkeys(names, 3)
    with pytest.raises(Exception, match="editions/1|PATH_NOT_FOUND"):
        read(1)


def test_sheets_round_trip(spark, tmp_path):
    import datetime as dt
    from decimal import Decimal

    sheets.register(spark)
    schema = "id long, `a text` string, n int, x double, b boolean, d date, t timestamp, m decimal(20,4)"
    odd = ["Null", "", " ", " a\tb\n", "a\r\nb\x0b\x01", "_x0041_", "<b> & 'c' \"d\" ]]>", "Ünïcödé \U0001f600", "007", "=1+1", "x" * 40_000, None]
    rows = [(2**53 + i, t, -i, i / 7, i % 2 == 0, dt.date(1999, 12, 31) + dt.timedelta(i), dt.datetime(2024, 2, 29, 12, 30, i, tzinfo=dt.UTC), Decimal(i) / 8) for i, t in enumerate(odd)]
    rows += [(None,) * 8, (-5, "nan", None, float("nan"), None, None, None, Decimal("1234567890123456.0001")), (6, "inf", 1, float("-inf"), None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    out = f"{tmp_path}/sheets"
    df.repartition(3).write.format("sheets").mode("overwrite").save(out)
    key = lambda rs: sorted(map(repr, rs))
    got = spark.read.format("sheets").schema(schema).load(out)
    assert key(got.collect()) == key(df.collect()) and got.rdd.getNumPartitions() == 3
    # Written again in place; read as text, by the header; columns by name.
    df.limit(2).coalesce(1).write.format("sheets").mode("overwrite").save(out)
    text = tables.read_table(spark, out, ["a text", "n"], "sheets")
    assert sorted(map(tuple, text.collect())) == [("", "-1"), ("Null", "0")]
    df.limit(1).coalesce(1).write.format("sheets").mode("append").save(f"file://{out}")
    assert spark.read.format("sheets").schema("n int, gone string").load(out).filter("n = 0 AND gone IS NULL").count() == 2
    df.limit(0).write.format("sheets").mode("overwrite").save(out)
    assert spark.read.format("sheets").load(out).count() == 0


def test_sheets_of_other_programs_and_failed_writes(spark, tmp_path):
    import zipfile

    sheets.register(spark)
    main, rel = sheets._MAIN.strip("{}"), sheets._REL.strip("{}")
    with zipfile.ZipFile(tmp_path / "book.XLSX", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="One" sheetId="1" r:id="a"/><sheet name="Two" sheetId="2" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="p"><Relationship Id="a" Target="worksheets/s1.xml"/><Relationship Id="b" Target="/xl/worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>Name</t></si><si><r><t>Gre</t></r><r><t xml:space="preserve">en </t></r><rPh><t>no</t></rPh></si></sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="200" formatCode="yyyy"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="200"/></cellXfs></styleSheet>')
        sheet = '<worksheet xmlns="%s"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="str"><f>1</f><v>Day</v></c></row><row><c t="s"><v>1</v></c><c r="C2" s="1"><v>45000</v></c></row><row r="3"><c r="A3" t="b"><v>1</v></c><c r="B3"/><c r="C3"><f>1+1</f><v>2.5</v></c></row></sheetData></worksheet>'
        for name in ("s1", "s2"):
            z.writestr(f"xl/worksheets/{name}.xml", sheet % main)
    one = spark.read.format("sheets").load(str(tmp_path))
    assert one.columns == ["Name", "column_2", "Day"]
    assert [tuple(r) for r in one.collect()] == [("Green ", None, "2023-03-15"), ("true", None, "2.5")]
    every = spark.read.format("sheets").schema("Day date").option("sheet", "*").load(str(tmp_path))
    assert sorted(str(r[0]) for r in every.collect()) == ["2023-03-15", "2023-03-15", "None", "None"] and every.rdd.getNumPartitions() == 2
    assert spark.read.format("sheets").schema("Name string").option("sheet", "Two").load(str(tmp_path)).count() == 2
    bad = spark.range(10).repartition(2).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("Name"))
    with pytest.raises(Exception, match="no"):
        bad.write.format("sheets").mode("overwrite").save(str(tmp_path))
    assert [p.name for p in tmp_path.iterdir()] == ["book.XLSX"]
