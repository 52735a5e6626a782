"""Secret scans with a random forest that removes false positives, in DataFrame functions and Spark's own forest only.

Candidates are runs of 16 or more key characters, and values of any alphabet and at least `SHORTEST` characters that are assigned to a secret's name. Their features are length,
character classes and the transitions between them, how much of them the corpus's own vocabulary covers, what the document's path (`source`) looks like, and
the neighbouring words. The forest is trained on labelled findings and gives each candidate the probability of being a secret; candidates under one half
are false positives.

Labelled findings are a table (the feature columns, value, before, after and `label`). The given tables have none, so `planted` writes texts in which it is
known by construction what is a secret: drawn keys, tokens and passwords where secrets stand, and numbers, words and names of the corpus, digests under their names, paths and
placeholders, both there and elsewhere. They pass the same scan as documents; no label is derived from a feature. The forest sees at most `SAMPLE`
findings of each label, those with the least hashes. The vocabulary counts all words of all documents and keeps those with a share of them, so that it means
the same at every size; the planted texts use `WORDS` of them. Runs of letters are cut greedily into the longest words of the vocabulary, so that `rivers_andmountains` is covered as a whole.

Defined results: null and empty texts have no candidates, a null source is an empty path. Rows that repeat a doc_id are scanned each by its own
text, and texts of any length whole. Of equal values in one word the first counts. Without findings of both labels nothing can be learned: every probability is the share of
secrets among the labelled (0 if none is). Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, store, table, text_of

CANDIDATE = "[A-Za-z0-9+/_=-]{16,}"
SHORTEST, SAMPLE, SECRET, PLANTED, WORDS = 6, 2000, 0.5, 8000, 500
#: A word of the vocabulary has this share of all words (so there are at most 500,000) and this many uses; within a longer run of letters it has at least `PIECE` letters.
LEAST_SHARE, LEAST_USES, LONGEST, PIECE = 2e-6, 20, 24, 4
#: Words near secrets, words near placeholders, and parts of paths.
SECRET_NAMES = "(?i)(token|secret|passw|pwd|api_?key|access_?key|private_?key|auth|credential|bearer)"
PLACEHOLDERS = "(?i)(example|dummy|sample|placeholder|changeme|your[_-]|xxxx|todo|redacted)"
TEST_PATHS, CODE_PATHS = "(?i)(test|example|sample|mock|fixture|doc)", "(?i)(\\.(py|js|ts|go|java|rb|php|ya?ml|json|env|ini|cfg|conf|toml|sh)$|config|src)"
#: A value right after a secret's name in one word, and what stands before one that is a word of its own.
ASSIGNED = SECRET_NAMES + "[\\w-]*[\"'\\]]*(?:=>|:=|[=:])[\"'`]?([^\\s\"'`,;]{%d,})" % SHORTEST
NAMED = SECRET_NAMES + "[\\w-]*[\"'\\]]* ?(?:=>|:=|[=:])$"
VALUE = "^[\"'`(\\[]*([^\\s\"'`,;]{%d,})" % SHORTEST
#: What stands before secrets, before other findings, and placeholders.
BEFORE_SECRETS = ["token =", "api_key:", "password =", "secret:", "export ACCESS_KEY =", "authorization: bearer", "db_pwd =", "private_key =", "auth_token:", "credentials: key ="]
BEFORE_OTHERS = ["commit", "sha256:", "etag =", "checksum:", "id =", "see", "number", "and the", "version =", "call"]
PLACES = ["your_api_key_goes_here", "xxxxxxxxxxxxxxxxxxxx", "changeme_changeme", "example-secret-value", "placeholder_token_value", "todo_replace_this_value"]
PATHS = ["src/app.py", "config/settings.yml", "notes", "web", "deploy/prod.env", "readme"]

FEATURES = [
    "length", "upper_share", "digit_share", "other_share", "class_turns", "vowel_turns", "distinct_share", "hex_only",
    "coverage", "test_path", "code_path", "path_length", "named_before", "named_after", "assigned", "quoted", "placeholder_near",
]


def _share(column: str, kept: str) -> Column:
    return F.length(F.regexp_replace(column, f"[^{kept}]", "")) / F.length(column)


def _turns(column: Column) -> Column:
    """How often neighbouring characters differ, a step."""
    return (F.length(F.regexp_replace(column, "(.)\\1+", "$1")) - 1) / F.greatest(F.length(column) - 1, F.lit(1))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, row, place (word number from 0), nth (within the word), value, before, after, source, word."""
    text = text_of()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.xxhash64(text, "source").alias("row"), text.alias("text"))
    rows = rows.withColumn("named", F.col("text").rlike(SECRET_NAMES)).filter(F.col("named") | F.col("text").rlike(CANDIDATE))
    words = F.split("text", SPACES)
    front = lambda w, i: F.array_join(F.slice(w, F.greatest(i - 2, F.lit(1)), F.least(i, F.lit(3))), " ")
    # Only texts with a secret's name have assigned values.
    assigned = lambda w, x, i: F.col("named") & (x.rlike(ASSIGNED) | (x.rlike(VALUE) & front(w, i).rlike(NAMED)))
    told = lambda w, x, i: F.struct(i.alias("place"), x.alias("word"), front(w, i).alias("before"), F.array_join(F.slice(w, i + 2, 2), " ").alias("after"))
    hits = lambda w: F.filter(F.transform(w, lambda x, i: F.when(x.rlike(CANDIDATE) | assigned(w, x, i), told(w, x, i))), lambda x: x.isNotNull())
    rows = rows.select("doc_id", "row", "source", F.inline(F.transform(F.array(words), hits)[0]))
    whole = F.when(F.col("word").rlike(ASSIGNED), F.regexp_extract("word", ASSIGNED, 2)).when(F.col("before").rlike(NAMED), F.regexp_extract("word", VALUE, 1)).otherwise("")
    runs = F.regexp_extract_all("word", F.lit(f"({CANDIDATE})"), F.lit(1))
    # Runs inside an assigned value, or of it and its name, are no candidates of their own.
    apart = F.when(F.col("whole") != "", F.concat(F.array("whole"), F.filter(runs, lambda r: ~F.col("whole").contains(r) & ~r.contains(F.col("whole"))))).otherwise(runs)
    return rows.withColumn("whole", whole).select("*", F.posexplode(F.array_distinct(apart)).alias("nth", "value")).drop("whole")


def vocabulary(docs: DataFrame, share: float = LEAST_SHARE, least: int = LEAST_USES) -> DataFrame:
    """Words of 3 to `LONGEST` letters that are at least `share` of all words of three letters or more, and used at least `least` times."""
    words = docs.select(F.explode(F.split(F.lower(text_of()), "[^\\p{L}]+")).alias("part")).filter(F.length("part") >= 3)
    # Of a longer word only the front is kept, to count it.
    words = words.select(F.substring("part", 1, LONGEST + 1).alias("part"))
    uses = store(words.groupBy("part").agg(F.count(F.lit(1)).alias("uses")), "word-uses")
    total = uses.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    return uses.filter((F.col("uses") >= max(least, share * total)) & (F.length("part") <= LONGEST)).select("part")


def covered_letters(runs: DataFrame, known: DataFrame) -> DataFrame:
    """run, part (distinct runs of the letters a-z, with a name) -> run, covered: how many of its letters words of the vocabulary cover, from left to right, the longest word at each place first."""
    # The letters from each place of a run on, so that long runs are read once; a run shorter than any piece is its own front.
    fronts = F.when(F.length("part") < PIECE, F.array("part")).otherwise(F.regexp_extract_all("part", F.lit(f"(?=([a-z]{{{PIECE},{LONGEST}}}))"), F.lit(1)))
    places = runs.select("run", F.posexplode(fronts).alias("at", "front"))
    size = F.length("front")
    pieces = places.select("run", "at", "front", F.explode(F.sequence(F.least(size, F.lit(PIECE)), size)).alias("n")).select("run", "at", F.expr("substring(front, 1, n)").alias("piece"))
    hits = pieces.join(known.select(F.col("part").alias("piece")), "piece").groupBy("run", "at").agg(F.max(F.length("piece")).alias("long"))
    # One place at most for each letter of a run.
    hits = hits.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("at", "long"))).alias("places"))
    start = F.struct(F.lit(0).alias("next"), F.lit(0).alias("covered"))
    step = lambda s, p: F.when(p["at"] < s["next"], s).otherwise(F.struct((p["at"] + p["long"]).alias("next"), (s["covered"] + p["long"]).alias("covered")))
    return hits.select("run", F.aggregate("places", start, step)["covered"].alias("covered"))


def featured(docs: DataFrame, known: DataFrame, salts: int = 16) -> DataFrame:
    """The candidates of `docs` (doc_id, text, source) with their features; `known` is the vocabulary (part)."""
    found = candidates(docs).withColumn("salt", F.pmod(F.xxhash64("doc_id", "place"), F.lit(salts)).cast("int"))
    # Values and runs go by a digest, as they may be long.
    found = store(found.withColumn("name", F.md5("value")), "candidates")
    # Each distinct value is measured against the vocabulary once, and goes back to its candidates under several salts, as one value may be a third of them.
    parts = found.groupBy("name").agg(F.first("value").alias("value")).select("name", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("([a-z]{3,})"), F.lit(1))).alias("part"))
    parts = store(parts.withColumn("run", F.md5("part")), "letter-runs")
    # One run of letters may be a third of them: it is cut once.
    words = store(covered_letters(parts.dropDuplicates(["run"]).select("run", "part"), known), "covered-letters")
    times = parts.groupBy("name", "run").agg(F.count(F.lit(1)).alias("times"))
    covered = store(times.join(words, "run").groupBy("name").agg(F.sum(F.col("covered") * F.col("times")).alias("covered")), "covered")
    covered = covered.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    out = found.join(covered, ["name", "salt"], "left").drop("salt", "name")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]", "\u0001"), "[A-Z]", "\u0002"), "[0-9]", "\u0003")
    classes = F.regexp_replace(classes, "[^\u0001-\u0003]", "\u0004")
    vowels = F.regexp_replace(F.regexp_replace(F.lower("value"), "[aeiouy]", "+"), "[a-z]", "-")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    front = F.expr("substring_index(word, value, 1)")
    return out.withColumns(
        {
            "length": F.length("value").cast("double"),
            "upper_share": _share("value", "A-Z"),
            "digit_share": _share("value", "0-9"),
            "other_share": F.length(F.regexp_replace("value", "[A-Za-z0-9]", "")) / F.length("value"),
            "class_turns": _turns(classes),
            "vowel_turns": _turns(vowels),
            "distinct_share": F.size(F.array_distinct(F.split("value", ""))) / F.length("value"),
            "hex_only": flag(F.col("value").rlike("^[0-9a-fA-F]+$")),
            "coverage": F.coalesce("covered", F.lit(0)) / F.length("value"),
            "test_path": flag(F.col("source").rlike(TEST_PATHS)),
            "code_path": flag(F.col("source").rlike(CODE_PATHS)),
            "path_length": F.length("source").cast("double"),
            "named_before": flag(F.col("before").rlike(SECRET_NAMES)) + flag(front.rlike(SECRET_NAMES)),
            "named_after": flag(F.col("after").rlike(SECRET_NAMES)),
            "assigned": flag(F.col("before").rlike("[=:]>?$") | front.rlike("[=:]>?[\"'`]?$")),
            "quoted": flag(F.col("word").rlike("[\"'`]")),
            "placeholder_near": flag(F.concat_ws(" ", "before", "word", "after").rlike(PLACEHOLDERS)),
        }
    ).drop("covered")


def planted(spark: SparkSession, known: DataFrame, n: int = PLANTED, words: int = WORDS) -> DataFrame:
    """doc_id, text, source, value, label: texts with one finding each, a secret (1) or not (0) by construction. Reruns give the same."""
    some = known.orderBy(F.xxhash64("part"), "part").limit(words).agg(F.sort_array(F.collect_list("part")).alias("some"))
    some = some.select(F.concat("some", F.array(*[F.lit(w) for w in ("value", "other", "between", "message", "number")])).alias("some"))
    rows = spark.range(n).crossJoin(F.broadcast(some))
    draw = lambda name, m: F.pmod(F.xxhash64(F.lit(name), "id"), F.lit(m)).cast("int")
    pick = lambda name, array, m: F.get(array, draw(name, m))
    fixed = lambda name, values: pick(name, F.array(*[F.lit(v) for v in values]), len(values))
    word = lambda name: F.get(F.col("some"), F.pmod(F.xxhash64(F.lit(name), "id"), F.size("some").cast("long")).cast("int"))
    digest = F.sha2(F.concat(F.lit("planted"), F.col("id").cast("string")).cast("binary"), 256)
    code = F.translate(F.base64(F.unhex(digest)), "=", "")
    digits = F.translate(digest, "abcdef", "172839")
    secrets = [
        F.substring(digest, 1, 40), F.substring(digest, 1, 32), F.concat(F.lit("sk_live_"), F.substring(F.regexp_replace(code, "[+/]", "x"), 1, 24)), F.substring(code, 1, 40), F.substring(F.regexp_replace(code, "[+/]", "_"), 1, 22),
        F.concat(F.initcap(word("p")), F.substring(digits, 1, 4), fixed("sign", ["!", "#", "&", "$", "%"]), F.substring(code, 1, 3)), F.substring(code, 1, 12), F.concat(F.substring(code, 1, 6), F.lit("!"), F.substring(code, 9, 4)),
    ]
    others = [
        F.substring(digits, 1, 16), F.substring(digits, 1, 20), F.concat(word("a"), word("b"), word("c"), word("d")), F.concat_ws("_", word("a"), word("b"), word("c")), F.concat(word("a"), F.initcap(word("b")), F.initcap(word("c"))),
        F.concat_ws("/", F.lit("src"), word("a"), word("b"), word("c")), F.repeat(fixed("line", ["=", "-", "_", "a", "0"]), 24), fixed("place", PLACES), F.concat_ws("-", word("a"), word("b"), F.substring(digits, 1, 4)),
    ]
    # Of twenty texts: ten secrets where secrets stand, two digests under their names, eight other things, half of them where secrets stand.
    turn = F.col("id") % 20
    label = F.when(turn < 10, 1.0).otherwise(0.0)
    value = F.when(turn < 10, pick("s", F.array(*secrets), len(secrets))).when(turn < 12, F.substring(digest, 1, 40)).otherwise(pick("o", F.array(*others), len(others)))
    value = F.when(F.length(value) < 16, F.when(turn < 16, value).otherwise(F.rpad(value, 18, "e"))).otherwise(value)
    before = F.when((turn < 10) | (turn >= 12) & (turn < 16), fixed("before", BEFORE_SECRETS)).otherwise(fixed("others", BEFORE_OTHERS))
    quote = F.when(draw("quote", 3) == 0, F.lit("")).otherwise('"')
    gap = F.when(F.col("before").rlike("[=:]$") & (draw("gap", 3) == 0), F.lit("")).otherwise(" ")
    rows = rows.select("id", "some", label.alias("label"), value.alias("value"), before.alias("before"), quote.alias("quote"), fixed("path", PATHS).alias("source"), word("x").alias("x"), word("y").alias("y"))
    near = F.when(gap == "", F.regexp_replace("before", " ([=:])$", "$1")).otherwise(F.col("before"))
    text = F.concat(F.col("x"), F.lit(" "), F.col("y"), F.lit(" "), near, gap, F.col("quote"), F.col("value"), F.col("quote"), F.lit(" "), F.col("y"), F.lit(" "), F.col("x"))
    return rows.select(F.col("id").alias("doc_id"), text.alias("text"), "source", "value", "label")


def labelled_findings(spark: SparkSession, known: DataFrame) -> DataFrame:
    """The planted findings as the scan sees them, with their labels."""
    texts = store(planted(spark, known), "planted")
    labels = texts.select(F.col("doc_id").alias("of"), F.col("value").alias("real"), "label")
    found = featured(texts.select("doc_id", "text", "source"), known)
    return found.join(labels, (F.col("doc_id") == F.col("of")) & (F.col("value") == F.col("real"))).drop("of", "real")


def scored(found: DataFrame, labelled: DataFrame, sample: int = SAMPLE, trees: int = 24, depth: int = 6, seed: int = 7) -> DataFrame:
    """`found` with `probability` from a forest that is trained on at most `sample` labelled findings of each label."""
    order = [F.xxhash64("value", "before", "after"), *[F.col(c) for c in FEATURES]]
    picked = [labelled.filter(F.col("label") == label).select("label", "value", "before", "after", *FEATURES).orderBy(*order).limit(sample) for label in (0.0, 1.0)]
    picked = store(picked[0].union(picked[1]), "labelled-findings")
    counts = dict(picked.groupBy("label").count().collect())
    if len(counts) < 2:
        return found.withColumn("probability", F.lit(1.0 if 1.0 in counts else 0.0))
    pack = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # At most twice `sample` rows, in a fixed order, so that reruns grow the same forest.
    rows = pack.transform(picked.coalesce(1).sortWithinPartitions(*order)).select("features", "label")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(rows)
    chance = vector_to_array("probability_vector")[1]
    forest.setProbabilityCol("probability_vector")
    return forest.transform(pack.transform(found)).withColumn("probability", chance).drop("features", "probability_vector", "rawPrediction", "prediction")


def secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate: doc_id, place, nth, value, probability, is_secret. `labelled` are findings with their features and `label`; without them, planted ones."""
    docs = docs.select("doc_id", "text", "source")
    known = store(vocabulary(docs), "vocabulary")
    found = store(featured(docs, known), "featured")
    labelled = labelled_findings(docs.sparkSession, known) if labelled is None else labelled
    return scored(found, labelled).withColumn("is_secret", F.col("probability") >= SECRET).select("doc_id", "place", "nth", "value", "probability", "is_secret")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    sha = F.sha2(F.encode("value", "UTF-8"), 256).alias("value_sha256")
    return found.select("doc_id", F.col("place").cast("long").alias("place"), F.col("nth").cast("long").alias("nth"), F.length("value").cast("long").alias("length"), sha, F.round("probability", 6).alias("probability"), "is_secret")
