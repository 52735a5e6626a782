"""DuckDB SQL of the registered queries, for comparison. Written apart from the Spark code, from the operators' definitions."""

from __future__ import annotations

from shelfmark.plans.views import BOXES, FLYER, FLYER_ODD, MASTER, PRINTED, RESPONSES, duck

_VIEWS = {"master0": MASTER, "flyer0": FLYER, "printed": PRINTED, "boxes0": BOXES, "responses": RESPONSES}


def _with(*names: str, more: str = "") -> str:
    return "WITH " + ",\n".join(f"{n} AS ({duck(_VIEWS[n])})" for n in names) + (f",\n{more}" if more else "")


def _micro(x: str) -> str:
    return f"CAST(floor(({x}) * 1e6 + 0.5) AS BIGINT)"


def _round2(x: str) -> str:
    return f"floor(({x}) * 100 + 0.5) / 100"


# Text features.
def _start(x: str) -> str:
    return f"regexp_replace(trim({x}), '^[^\\p{{L}}\\p{{N}}]+', '')"


def _words(x: str) -> str:
    return f"regexp_extract_all({_start(x)}, '[A-Za-z]+')"


_DV = "w[1] || translate(w[2:], 'aeiouAEIOU', '')"
_LAST = "CASE WHEN length(w) <= 2 THEN w ELSE w[1] || translate(w[2:length(w) - 1], 'aeiouAEIOU', '') || w[length(w):] END"


def _devowel(x: str) -> str:
    return f"array_to_string(list_transform({_words(x)}, lambda w: {_DV}), '')"


def _f_side(x: str) -> str:
    """Flyer features: devowelled prefix, capitals, first character, word variants."""
    variants = ", ".join(f"list_transform({_words(x)}, lambda w: lower({v}))" for v in ("w", _DV, _LAST))
    return f"left(lower({_devowel(x)}), 3) AS f_dv, regexp_replace({x}, '[^A-Z]', '', 'g') AS f_up, lower(left({_start(x)}, 1)) AS f_fc, list_distinct(flatten([{variants}])) AS f_words"


def _m_side(x: str, p: str) -> str:
    return f"left(lower({_start(x)}), 3) AS {p}_st, regexp_replace({x}, '[^A-Z]', '', 'g') AS {p}_up, length(regexp_extract(trim({x}), '^\\S+')) AS {p}_n, lower(left({_start(x)}, 1)) AS {p}_fc, list_distinct(list_transform({_words(x)}, lambda w: lower(w))) AS {p}_words"


def _parts(p: str) -> dict[str, str]:
    return {
        "devowel": f"CAST(f_dv <> '' AND {p}_st <> '' AND f_dv = {p}_st AS INT)",
        "upper": f"CAST(CASE WHEN {p}_n > 0 THEN rpad(f_up, CAST({p}_n AS INT), '_') = rpad({p}_up, CAST({p}_n AS INT), '_') ELSE f_up = {p}_up END AS INT)",
        "first": f"CAST(f_fc <> '' AND f_fc = {p}_fc AS INT)",
        "word": f"CAST(len(list_intersect({p}_words, f_words)) AS INT)",
    }


def _boost(p: str) -> str:
    v = _parts(p)
    return f"((({v['devowel']} * 4e-1) + ({v['upper']} * 4e-1)) + ({v['first']} * 2e-1)) + ({v['word']} * 5e-1)"


def _tokens(x: str) -> str:
    return f"regexp_extract_all(regexp_replace(lower(trim({x})), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '[\\p{{L}}\\p{{N}}_]+')"


def _jaccard(a: str, b: str) -> str:
    x, y = f"list_distinct({_tokens(a)})", f"list_distinct({_tokens(b)})"
    return f"len(list_intersect({x}, {y})) * 1e0 / len(list_distinct(list_concat({x}, {y})))"


def _plain(x: str) -> str:
    return f"regexp_replace(lower(trim({x})), '[^a-z0-9\\s]', '', 'g')"


def _contained(a: str, b: str) -> str:
    return f"CASE WHEN {_plain(a)} <> '' AND {_plain(b)} <> '' AND contains({_plain(a)}, {_plain(b)}) THEN 1e0 ELSE 0e0 END"


# Ratios over longest common subsequences, one row a pair of texts and part of the ratio, so that the engine splits the work.
def _lcs(p: str, q: str) -> str:
    """Bit i of the carried row says that letter i of `p` isn't used yet."""
    places = f"list_transform(string_split({q}, ''), lambda x: list_sum(list_transform(generate_series(1, length({p})), lambda i: CASE WHEN {p}[i] = x THEN 1::HUGEINT << CAST(i - 1 AS INT) ELSE 0::HUGEINT END))::HUGEINT)"
    every = f"((1::HUGEINT << CAST(length({p}) AS INT)) - 1)"
    return f"length({p}) - bit_count(list_reduce({places}, lambda r, m: ((r + (r & m)) | (r - (r & m))) & {every}, {every}))"


def _ratios(name: str, parts: str) -> str:
    """CTEs: `name`(id, score) is the best weighted ratio of each id, from rows (id, weight, part, a, b) of `parts`, where `part` asks for the best window."""
    return f"""{name}_p AS (SELECT id, weight, part, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS p, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS q FROM ({parts})),
{name}_w AS (SELECT id, weight, p, unnest(CASE WHEN p = '' THEN [q] WHEN part THEN list_transform(generate_series(1 - length(p), length(q) - 1), lambda i: q[greatest(0, i) + 1:i + length(p)]) ELSE [q] END) AS w, p = '' AND part AS none FROM {name}_p),
{name}_l AS (SELECT p, w, CASE WHEN p = '' THEN 0 ELSE {_lcs('p', 'w')} END AS lcs FROM (SELECT DISTINCT p, w FROM {name}_w)),
{name} AS (SELECT id, max(weight * CASE WHEN p = '' AND w = '' THEN 100e0 WHEN none THEN 0e0 ELSE 200e0 * lcs / (length(p) + length(w)) END) AS score FROM {name}_w JOIN {name}_l USING (p, w) GROUP BY id)"""


def _partial(name: str, pairs: str) -> str:
    """CTEs: `name`(id, score) of the pairs (id, a, b)."""
    return _ratios(name, f"SELECT id, 1e0 AS weight, true AS part, a, b FROM {pairs}")


def _weighted(name: str, pairs: str) -> str:
    """CTEs: `name`(id, score), the weighted best of plain, token and partial ratios of the pairs (id, a, b), texts that aren't empty."""
    ordered = lambda x: f"array_to_string(list_sort({x}), ' ')"
    word = lambda x: f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"
    token = "SELECT id, {w} AS weight, part, {a} AS a, {b} AS b FROM {name}_t"
    rows = [("1e0", "a", "b"), ("9.5e-1 * scale", ordered("x"), ordered("y")), ("9.5e-1 * scale", "trim(same || ' ' || rest_x)", "trim(same || ' ' || rest_y)")]
    rows += [("9.5e-1 * scale", "same", f"trim(same || ' ' || {r})") for r in ("rest_x", "rest_y")]
    plain = f"SELECT id, 1e0 AS weight, false AS part, a, b FROM {name}_t UNION ALL SELECT id, scale, part, a, b FROM {name}_t WHERE part"
    more = " UNION ALL ".join(token.format(w=w, a=a, b=b, name=name) + (" WHERE same <> ''" if a == "same" else " WHERE len(x) > 0 AND len(y) > 0" if "same" in a else "") for w, a, b in rows[1:])
    return f"""{name}_n AS (SELECT *, {word('a')} AS x, {word('b')} AS y, greatest(length(a), length(b)) * 1e0 / least(length(a), length(b)) AS longer FROM {pairs} WHERE a <> '' AND b <> ''),
{name}_t AS (SELECT *, longer >= 1.5 AS part, CASE WHEN longer < 1.5 THEN 1e0 WHEN longer <= 8 THEN 9e-1 ELSE 6e-1 END AS scale, {ordered('list_distinct(list_intersect(x, y))')} AS same,
  {ordered('list_filter(list_distinct(x), lambda w: NOT list_contains(y, w))')} AS rest_x, {ordered('list_filter(list_distinct(y), lambda w: NOT list_contains(x, w))')} AS rest_y FROM {name}_n),
{_ratios(name, plain + ' UNION ALL ' + more)}"""


# Numbers.
def _numbers(x: str) -> str:
    return f"list_transform(regexp_extract_all({x}, '[0-9]+\\.?[0-9]*'), lambda n: CAST(n AS DOUBLE))"


def _number_similarity(a: str, b: str) -> str:
    x, y = _numbers(a), _numbers(b)
    v = f"CASE WHEN len({y}) = 2 THEN ({y}[1] + {y}[2]) / 2 ELSE {y}[1] END"
    lo = f"{x}[1]"
    near = lambda d: _round2(f"greatest(0e0, (1 - ({d}) / greatest({lo}, {v})) * 100)")
    return (
        f"CASE WHEN len({x}) = 0 OR len({y}) = 0 THEN 0e0 WHEN len({x}) = 2 AND {v} BETWEEN {x}[1] AND {x}[2] THEN 100e0 WHEN {lo} = 0 THEN 0e0 "
        f"WHEN len({x}) = 2 THEN {near(f'least(abs({lo} - {v}), abs({x}[2] - {v}))')} ELSE {near(f'abs({lo} - {v})')} END"
    )


def _money(x: str) -> str:
    return f"TRY_CAST(replace(replace({x}, '$', ''), ',', '') AS DOUBLE)"


def _price_similarity(a1: str, a2: str, f1: str, f2: str) -> str:
    v1, v2 = f"({_money(a1)} / nullif({_money(f1)}, 0))", f"({_money(a2)} / nullif({_money(f2)}, 0))"
    near = _round2(f"greatest(0e0, (1 - abs({v1} - {v2}) / greatest(abs({v1}), abs({v2}), 1e-9)) * 100)")
    return f"CASE WHEN {v1} IS NULL OR {v2} IS NULL THEN 0e0 WHEN {v1} = {v2} THEN 100e0 ELSE {near} END"


# Cleaning.
def _null(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR trim({x}) IN ('', 'nan', 'NaT', 'null', 'NULL', 'None') THEN 'Null' ELSE trim({x}) END"


def _cleaned(columns: list[str], source: str, row: str, required: list[str], other: list[str]) -> str:
    cols = ", ".join(f"{_null(x)} AS {x}" for x in columns)
    keys = ", ".join(f"trim({x})" if x in columns else x for x in required)
    one = f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {row}) = 1"
    return f"SELECT {', '.join([row, *other])}, {cols} FROM ({one})"


_TEXT = ["Description", "Size", "Pack", "Retail_Factor", "Retail_Amt"]
_OK = "lower(trim(Description)) NOT IN ('', 'null')"
_F = _cleaned(_TEXT, "flyer0", "flyer_row", [*_TEXT, "Page_Number"], ["Page_Number"])
_M = _cleaned([*_TEXT, "nCat_Desc", "BRAND"], "master0", "master_row", [*_TEXT, "nCat_Desc", "BRAND"], [])
PREPARED = _with(
    "flyer0",
    "master0",
    more=f"""flyer AS (SELECT * FROM ({_F}) WHERE {_OK}),
masterc AS (SELECT * FROM ({_M}) WHERE {_OK}),
master AS (SELECT * FROM masterc QUALIFY row_number() OVER (PARTITION BY Description, nCat_Desc, BRAND ORDER BY master_row) = 1),
ff AS (SELECT flyer_row, Description AS f_text, {_f_side('Description')} FROM flyer),
mf AS (SELECT master_row, Description AS m_text, BRAND AS b_text, nCat_Desc AS c_text, {_m_side('Description', 'm')}, {_m_side('BRAND', 'b')} FROM master),
pairs AS (SELECT * FROM (SELECT flyer_row, master_row, f_text, m_text, b_text, c_text, ({_boost('m')}) + ({_boost('b')}) AS boost FROM ff, mf) WHERE boost >= 0.2 - 1e-9)""",
)
SCORED = f"""{PREPARED},
scored0 AS (SELECT flyer_row, master_row, f_text, m_text, boost, {_contained('f_text', 'b_text')} AS bw, {_contained('f_text', 'c_text')} AS nw, {_jaccard('f_text', 'm_text')} AS llm FROM pairs),
scored1 AS (SELECT *, boost + bw + nw AS total FROM scored0),
scored AS (SELECT *, CASE WHEN max(total) OVER () > min(total) OVER () THEN (total - min(total) OVER ()) / (max(total) OVER () - min(total) OVER ()) ELSE 0e0 END AS scaled FROM scored1),
top AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY f_text ORDER BY total DESC, flyer_row, master_row) <= 65)"""
RESULTS = f"""{SCORED},
wide AS (SELECT t.*, upper(trim(f_text)) AS fk, upper(trim(m_text)) AS mk, f.Size AS f_size, f.Pack AS f_pack, f.Retail_Factor AS f_factor, f.Retail_Amt AS f_amt, f.Page_Number AS f_page,
  m.Size AS m_size, m.Pack AS m_pack, m.Retail_Factor AS m_factor, m.Retail_Amt AS m_amt FROM top t JOIN flyer f USING (flyer_row) JOIN master m USING (master_row)),
numbered AS (SELECT *, {_number_similarity('f_size', 'm_size')} AS size_s, {_price_similarity('f_amt', 'm_amt', 'f_factor', 'm_factor')} AS price_s FROM wide),
classed AS (SELECT *, CASE WHEN llm >= 0.7 AND price_s = 100 AND size_s >= 80 THEN 'exact' WHEN llm >= 0.7 OR (bw >= 0.85 AND nw >= 0.2) THEN 'partial' ELSE 'other' END AS match_class FROM numbered),
ordered AS (SELECT *, CAST({_round2('price_s')} >= 99 AS INT) AS near, {_round2('llm')} AS llm2, {_round2('scaled')} AS scaled2 FROM classed),
exact AS (SELECT * FROM ordered WHERE match_class = 'exact' QUALIFY row_number() OVER (PARTITION BY mk ORDER BY near DESC, llm2 DESC, scaled2 DESC, f_text, total DESC, flyer_row, master_row) = 1),
partial AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY mk ORDER BY near DESC, llm2 DESC, scaled2 DESC, f_text, total DESC, flyer_row, master_row) AS INT) AS place
  FROM ordered WHERE match_class = 'partial' AND mk NOT IN (SELECT mk FROM exact)) WHERE place <= 5),
fulls AS (SELECT DISTINCT master_row, upper(trim(Description)) AS Description, Size, Pack, Retail_Factor, Retail_Amt, nCat_Desc, BRAND FROM masterc)"""

READ_TABLE = "SELECT p_partkey, p_name, p_type FROM part"
PARSE_LABEL = _with("responses") + " SELECT image_row, CASE WHEN json_valid(label_json) THEN CAST(json_extract(label_json, '$.clusters[0].label') AS INT) END AS label FROM responses"
_ITEM = ", ".join(f"json_extract_string(x, '$.{f}') AS {f}" for f in ("Size", "Pack", "RetailAmount", "RetailFactor", "Description", "Ad"))
_EACH = "SELECT image_row, image_name, unnest(json_extract(items_json, '$.extracted_data[*]')) AS x FROM responses"
PARSE_ITEMS = _with("responses") + f" SELECT image_row, {_ITEM} FROM ({_EACH})"
LIST_FILES = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split())
WRITE_RESULTS = _with("master0", "printed") + " SELECT 'master' AS result, count(*) AS rows FROM master0 UNION ALL SELECT 'flyer', count(*) FROM printed UNION ALL SELECT 'empty', 0"
SHEETS = """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Null' WHEN 3 THEN ' <&> ' || p_name ELSE p_name END AS note, p_size, p_retailprice, p_size > 10 AS large,
CAST(DATE '2020-02-27' + CAST(p_partkey % 400 AS INT) AS DATE) AS since FROM part"""
NORMALIZE_COLUMNS = "SELECT p_partkey AS part_key, p_name AS Name_short, p_size AS size_oz FROM part"
PREFIX_COLUMNS = _with("printed") + " SELECT flyer_row, Description AS PDF_Description, Size AS PDF_Size, Pack AS PDF_Pack, Retail_Factor AS PDF_Retail_Factor, Retail_Amt AS PDF_Retail_Amt, Page_Number AS PDF_Page_Number FROM printed"
SELECT_EXISTING = _with("master0") + " SELECT Description, BRAND, master_row FROM master0"
CLEAN_TABLE = _with("master0") + " " + _cleaned([*_TEXT, "nCat_Desc", "BRAND"], "master0", "master_row", ["nCat_Desc", "BRAND", "Pack"], [])
CLEAN_DISTINCT = _with("master0") + " SELECT DISTINCT " + ", ".join(f"CASE WHEN trim({x}) IN ('', 'nan', 'NaT', 'None', 'NoneType') THEN 'Null' ELSE trim({x}) END AS {x}" for x in ("Description", "Pack", "BRAND")) + " FROM master0"
VALID_DESCRIPTION = _with("printed") + " SELECT flyer_row, Pack AS Description FROM printed WHERE lower(trim(Pack)) NOT IN ('', 'null')"
_SIX = ("Size", "Pack", "RetailAmount", "RetailFactor", "Description", "Ad")
_TIDY = ", ".join(f"trim(regexp_replace({f}, '\\s+', ' ', 'g')) AS {f}" for f in _SIX)
_BLANK = lambda fs, t="{}": " AND ".join(f"({t.format(f)} IS NULL OR regexp_matches({t.format(f)}, '^\\s*$') OR upper({t.format(f)}) = 'NULL')" for f in fs)
CLEAN_ITEMS = _with("responses") + f" SELECT * FROM (SELECT image_row, image_name, {_TIDY}, TRY_CAST(regexp_extract(image_name, '_page_(\\d+)', 1) AS INT) AS Page_Number FROM (SELECT image_row, image_name, {_ITEM} FROM ({_EACH}))) WHERE NOT ({_BLANK(_SIX[:5])})"
REJECT_EMPTY = _with("responses") + f", i AS (SELECT image_row, {_ITEM} FROM ({_EACH})) SELECT DISTINCT image_row FROM i WHERE image_row NOT IN (SELECT image_row FROM i WHERE {_BLANK(_SIX)})"
DEDUP_FIRST = _with("master0") + " SELECT * FROM master0 QUALIFY row_number() OVER (PARTITION BY Description, nCat_Desc, BRAND ORDER BY master_row) = 1"
UPPER_DESCRIPTIONS = _with("printed") + " SELECT flyer_row, upper(trim(Description)) AS Description FROM printed"
_LOW = lambda x: f"greatest(0e0, CAST({x} AS DOUBLE)) AS {x}"
_HIGH = lambda x, top: f"least(CAST({x} AS DOUBLE), CAST({top} AS DOUBLE)) AS {x}"
_BOX = _with("boxes0", more=f"b AS (SELECT image_name, box_idx, {_LOW('x1')}, {_LOW('y1')}, {_HIGH('x2', 'img_w')}, {_HIGH('y2', 'img_h')} FROM boxes0), boxes AS (SELECT *, x2 - x1 < 3 OR y2 - y1 < 3 AS bad FROM b)")
CROPS = _BOX + " SELECT image_name, box_idx, regexp_replace(image_name, '\\.[^.]*$', '') || '_crop_' || CAST(box_idx AS VARCHAR) || '.jpg' AS crop_name, " + ", ".join(f"CAST(trunc({x}) AS INT) AS {x}" for x in ("x1", "y1", "x2", "y2")) + " FROM boxes WHERE NOT bad"
SKIPPED = _BOX + " SELECT image_name, box_idx, " + ", ".join(f"printf('%.2f', {x}) AS {x}" for x in ("x1", "y1", "x2", "y2")) + ", 'Tiny or invalid box' AS reason FROM boxes WHERE bad"
BOX_SUMMARY = _BOX + " SELECT image_name, count(*) AS detections, count(*) FILTER (WHERE NOT bad) AS crops, count(*) FILTER (WHERE bad) AS skipped FROM boxes GROUP BY ROLLUP (image_name)"
TEXT_START = f"SELECT doc_id, md5({_start('text')}) AS start_md5 FROM documents"
DEVOWEL = f"SELECT p_partkey, {_devowel('p_name')} AS devowelled FROM part"
_ONE = _with("printed", "master0", more="sides AS (SELECT p.*, m.Description AS m_text, m.BRAND AS m_brand, m.nCat_Desc AS m_cat, m.Size AS m_size, m.Pack AS m_pack, m.Retail_Factor AS m_factor, m.Retail_Amt AS m_amt FROM printed p JOIN master0 m ON p.flyer_row = m.master_row)")
BOOST_PARTS = _ONE + f", s AS (SELECT flyer_row, {_f_side('Description')}, {_m_side('m_text', 'm')} FROM sides) SELECT flyer_row AS PDF_flyer_row, " + ", ".join(f"{v} AS {k}_score" for k, v in _parts("m").items()) + f", {_micro(_boost('m'))} AS boost, array_to_string(list_sort(list_intersect(m_words, f_words)), ' ') AS words FROM s"
TOKENIZE = f"SELECT doc_id, CAST(len({_tokens('text')}) AS BIGINT) AS n_tokens, md5(array_to_string({_tokens('text')}, ' ')) AS tokens_md5 FROM documents"
MATCH_SCORE = _ONE + f" SELECT flyer_row AS PDF_flyer_row, {_contained('Description', 'm_cat')} AS score, CASE WHEN {_contained('Description', 'm_cat')} = 1 THEN 'full_string' ELSE 'none' END AS mode, {_plain('m_cat')} AS field, {_plain('Description')} AS flyer FROM sides"
FIRST_NUMBER = "SELECT event_id, TRY_CAST(regexp_extract(props, '[-+]?[0-9]*\\.?[0-9]+') AS DOUBLE) AS number FROM events"
_N = _numbers("Size")
PARSE_NUMBERS = _ONE + f" SELECT flyer_row AS PDF_flyer_row, {_N}[1] AS lo, CASE WHEN len({_N}) = 2 THEN {_N}[2] ELSE {_N}[1] END AS hi, CASE WHEN len({_N}) > 0 THEN len({_N}) = 2 END AS is_range FROM sides"
NUMERIC_SIMILARITIES = _ONE + f" SELECT flyer_row AS PDF_flyer_row, {_number_similarity('Size', 'm_size')} AS Size_Similarity, {_number_similarity('Pack', 'm_pack')} AS Pack_Similarity, {_number_similarity('Retail_Factor', 'm_factor')} AS Retail_Factor_Similarity, {_price_similarity('Retail_Amt', 'm_amt', 'Retail_Factor', 'm_factor')} AS Retail_Amt_Similarity FROM sides"
COERCE_SCORES = _with("master0") + f" SELECT master_row, {_round2('coalesce(TRY_CAST(Retail_Factor AS DOUBLE), 0)')} AS a, {_round2('coalesce(TRY_CAST(Size AS DOUBLE), 0)')} AS b FROM master0"
SCORE_TO_UNIT = "SELECT p_partkey, CASE WHEN p_size > 1 THEN CAST(p_size AS DOUBLE) / 100 ELSE CAST(p_size AS DOUBLE) END AS unit FROM part"
CANDIDATE_PAIRS = f"{PREPARED} SELECT flyer_row, master_row, {_micro('boost')} AS boost FROM pairs"
_COS = "coalesce(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 0)"
COSINE = f"SELECT a.vec_id, {_micro(_COS)} AS cosine_millionths FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1"
LOOKUP = f"SELECT o_orderkey, {_micro(_COS)} AS similarity_millionths FROM orders LEFT JOIN embeddings a ON a.vec_id = o_custkey LEFT JOIN embeddings b ON b.vec_id = o_orderkey"
MERGE_SCORES = "SELECT p_partkey, CAST(CASE WHEN p_size > 10 THEN p_size WHEN p_size > 5 THEN -p_size END AS DOUBLE) AS LLM_Similarity FROM part"
DISTINCT_TEXTS = _ONE + " SELECT Description AS text FROM sides UNION SELECT m_text FROM sides UNION SELECT m_brand FROM sides"
COMBINED = f"{SCORED} SELECT flyer_row, master_row, {_micro('total')} AS total, {_micro('scaled')} AS scaled FROM scored"
TOP_K = f"{SCORED} SELECT flyer_row, master_row, {_micro('total')} AS total FROM top"
CLASSIFY = f"{RESULTS} SELECT flyer_row, master_row, match_class FROM classed"
BEST_EXACT = f"{RESULTS} SELECT flyer_row, master_row, mk AS Excel_Description FROM exact"
RANK_PARTIAL = f"{RESULTS} SELECT flyer_row, master_row, mk AS Excel_Description, place AS Match_Order FROM partial"
UNMATCHED_FLYER = f"{RESULTS.replace(duck(FLYER), duck(FLYER_ODD))} SELECT DISTINCT upper(trim(Description)) AS Description, Size, Pack, Retail_Factor, Retail_Amt, Page_Number FROM flyer WHERE upper(trim(Description)) NOT IN (SELECT fk FROM exact UNION SELECT fk FROM partial)"
UNMATCHED_MASTER = f"{RESULTS} SELECT * FROM fulls WHERE Description NOT IN (SELECT mk FROM exact UNION SELECT mk FROM partial)"
MATCH_FLAG = f"{RESULTS} SELECT master_row, CASE WHEN Description IN (SELECT mk FROM exact) THEN 'Exact Match' WHEN Description IN (SELECT mk FROM partial) THEN 'Partial Match' ELSE 'Unmatched' END AS Match_Flag FROM fulls"
MATCHED_KEYS = f"{RESULTS} SELECT mk AS Excel_Description FROM exact UNION SELECT mk FROM partial"
RESULT_COUNTS = f"""{RESULTS} SELECT 'Exact_Matches' AS result, count(*) AS rows FROM exact UNION ALL SELECT 'Partial_Matches', count(*) FROM partial
UNION ALL SELECT 'PDF_Unmatched', count(*) FROM (SELECT DISTINCT fk, f_size, f_pack, f_factor, f_amt, f_page FROM classed WHERE fk NOT IN (SELECT fk FROM exact UNION SELECT fk FROM partial))
UNION ALL SELECT 'Excel_Unmatched', count(*) FROM fulls WHERE Description NOT IN (SELECT mk FROM exact UNION SELECT mk FROM partial) UNION ALL SELECT 'Match_Flag', count(*) FROM fulls"""
ENTROPY = f"""WITH ch AS (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents), n AS (SELECT doc_id, ch, count(*) AS n FROM ch WHERE ch <> '' GROUP BY ALL),
e AS (SELECT doc_id, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS entropy FROM n GROUP BY doc_id) SELECT doc_id, {_micro('entropy')} AS entropy_millionths, entropy < 2.8 AS noisy FROM e"""
BYTE_ENTROPY = f"""WITH o AS (SELECT page_id, unnest(regexp_extract_all(hex(encode(html)), '..')) AS o FROM pages), n AS (SELECT page_id, o, count(*) AS n FROM o GROUP BY ALL),
e AS (SELECT page_id, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS entropy FROM n GROUP BY page_id) SELECT page_id, {_micro('entropy')} AS entropy_millionths, entropy < 3.1 AS noisy FROM e"""
NOISE_COUNTS = f"WITH x AS ({ENTROPY}) SELECT count(*) FILTER (WHERE noisy) AS noisy, count(*) FILTER (WHERE NOT noisy) AS clean FROM x"
VALUE_ENTROPY = f"""WITH n AS (SELECT l_partkey, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL), e AS (SELECT l_partkey, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS entropy FROM n GROUP BY l_partkey)
SELECT l_partkey, {_micro('entropy')} AS entropy_millionths, entropy < 1.7 AS noisy FROM e"""
# Hashed trigrams of a text between two spaces and one, 256 places, to length 1.
ENCODE = _with("master0") + """, t AS (SELECT Description AS text FROM master0 UNION SELECT BRAND FROM master0),
p AS (SELECT text, '  ' || lower(text) || ' ' AS s FROM t), g AS (SELECT text, unnest(list_transform(generate_series(1, length(s) - 2), lambda k: s[k:k + 2])) AS g FROM p),
h AS (SELECT text, ((ord(g[1]) * 1000003 + ord(g[2])) % 4294967291 * 1000003 + ord(g[3])) % 4294967291 % 256 AS place FROM g),
n AS (SELECT text, place, count(*) AS n FROM h GROUP BY ALL), v AS (SELECT text, place, n / sqrt(sum(n * n) OVER (PARTITION BY text)) AS v FROM n)
SELECT text, CAST(place AS BIGINT) AS place, CAST(floor(CAST(CAST(v AS FLOAT) AS DOUBLE) * 1e4 + 0.5) AS BIGINT) AS ten_thousandths FROM v"""
_STAGES = _with("responses") + ", l AS (SELECT image_name, list_sum(list_transform(string_split(image_name, ''), lambda x: ord(x))) % 5 AS label FROM responses), st AS (SELECT image_name, CAST(label AS INT) AS label, CASE WHEN label NOT IN (1, 2, 3) THEN 'classification' WHEN label = 3 OR (label = 2 AND length(image_name) % 2 = 0) THEN 'extraction' ELSE 'done' END AS stage FROM l)"
EXTRACT_ITEMS = _STAGES + " SELECT image_name, label AS Cluster, CAST(label AS VARCHAR) || ' oz' AS Size, CAST(NULL AS VARCHAR) AS Pack, CAST(NULL AS VARCHAR) AS RetailAmount, CAST(NULL AS VARCHAR) AS RetailFactor, image_name AS Description, CAST(NULL AS VARCHAR) AS Ad, TRY_CAST(regexp_extract(image_name, '_page_(\\d+)', 1) AS INT) AS Page_Number FROM st WHERE stage = 'done'"
EXTRACTION_COUNTS = _STAGES + " SELECT count(*) FILTER (WHERE stage <> 'classification') AS classified, count(*) FILTER (WHERE stage = 'classification') AS classification_failed, count(*) FILTER (WHERE stage = 'done') AS extracted, count(*) FILTER (WHERE stage = 'extraction') AS extraction_failed FROM st"
_MOOD = "list_sum(list_transform(string_split(m_text, ''), lambda x: ord(x))) % 7"
SCORING_COUNTS = _ONE + f", mood AS (SELECT {_MOOD} AS m FROM sides), r AS (SELECT 1 AS round, m FROM mood UNION ALL SELECT 2, m FROM mood WHERE m < 2) SELECT round, count(*) AS pairs, count(*) FILTER (WHERE m < 2) AS failed, CAST(0 AS BIGINT) AS late, true AS timed FROM r GROUP BY round"
SCORE_PAIRS = _ONE + f" SELECT flyer_row AS PDF_flyer_row, {_micro(_jaccard('Description', 'm_text'))} AS score FROM sides"
MATCH_PLAIN = f"{SCORED} SELECT flyer_row, master_row, f_text AS PDF_Description, m_text AS Excel_Description, {_micro('scaled')} AS combined, {_micro('llm')} AS model FROM top"
_TEXT_PAIRS = lambda c: _ONE + f", texts AS (SELECT DISTINCT Description, {c} AS field FROM sides), jobs AS (SELECT row_number() OVER () AS id, Description, field, {_plain('field')} AS a, {_plain('Description')} AS b FROM texts)"
_FUZZY = " SELECT Description AS PDF_Description, field AS {name}, " + _micro("coalesce(score, 0)") + " AS score_millionths FROM jobs LEFT JOIN found USING (id)"
PARTIAL_RATIO = f"{_TEXT_PAIRS('m_brand')}, {_partial('found', 'jobs')}{_FUZZY.format(name='Excel_BRAND')}"
WRATIO = f"{_TEXT_PAIRS('m_cat')}, {_weighted('found', 'jobs')}{_FUZZY.format(name='Excel_nCat_Desc')}"
# The full match from the list of all candidates: vectors, ratios and boosts of each pair of texts, joined to the pairs.
_VECTOR = """vt AS (SELECT DISTINCT unnest([f_text, m_text, b_text, c_text]) AS text FROM pairs),
vg AS (SELECT text, unnest(list_transform(generate_series(1, length(s) - 2), lambda k: s[k:k + 2])) AS g FROM (SELECT text, '  ' || lower(text) || ' ' AS s FROM vt)),
vh AS (SELECT text, ((ord(g[1]) * 1000003 + ord(g[2])) % 4294967291 * 1000003 + ord(g[3])) % 4294967291 % 256 AS place FROM vg),
vn AS (SELECT text, place, count(*) AS n FROM vh GROUP BY ALL), v AS (SELECT text, place, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY text)) AS FLOAT) AS DOUBLE) AS v FROM vn)"""
_ALIKE = "{0} AS (SELECT f_text, {1}, floor(coalesce(sum(x.v * y.v), 0) * 1e9 + 0.5) / 1e9 AS sim FROM (SELECT DISTINCT f_text, {1} FROM pairs) LEFT JOIN v x ON x.text = f_text LEFT JOIN v y ON y.text = {1} AND y.place = x.place GROUP BY ALL)"
_WORDS_OF = "{0}_j AS (SELECT row_number() OVER () AS id, f_text, {1}, " + f"{_plain('{1}')} AS a, {_plain('f_text')} AS b" + " FROM (SELECT DISTINCT f_text, {1} FROM pairs))"
_WORD = "{0}_s AS (SELECT f_text, {1}, CASE WHEN a = '' OR b = '' THEN 0e0 WHEN contains(b, a) THEN 1e0 ELSE score / 100 END AS word FROM {0}_j LEFT JOIN {0} USING (id))"
MATCH_CATALOGUE = f"""{PREPARED}, {_VECTOR}, {_ALIKE.format('sd', 'm_text')}, {_ALIKE.format('sb', 'b_text')}, {_ALIKE.format('sc', 'c_text')},
{_WORDS_OF.format('bw', 'b_text')}, {_partial('bw', 'bw_j')}, {_WORD.format('bw', 'b_text')}, {_WORDS_OF.format('nw', 'c_text')}, {_weighted('nw', 'nw_j')}, {_WORD.format('nw', 'c_text')},
scored AS (SELECT p.*, sd.sim AS d, sc.sim AS n, sb.sim AS b, bw_s.word AS bw, nw_s.word AS nw, sd.sim + sc.sim + sb.sim + boost + bw_s.word + nw_s.word AS total FROM pairs p
  JOIN sd USING (f_text, m_text) JOIN sb USING (f_text, b_text) JOIN sc USING (f_text, c_text) JOIN bw_s USING (f_text, b_text) JOIN nw_s USING (f_text, c_text)),
ends AS (SELECT min(total) AS low, max(total) AS high FROM scored),
top AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY f_text ORDER BY total DESC, flyer_row, master_row) <= 65)
SELECT flyer_row, master_row, f_text AS PDF_Description, m_text AS Excel_Description, {', '.join(f'{_micro(x)} AS {n}' for x, n in (('d', 'description'), ('b', 'brand'), ('n', 'category'), ('boost', 'boost'), ('bw', 'brand_words'), ('nw', 'category_words'), ('CASE WHEN high > low THEN (total - low) / (high - low) ELSE 0 END', 'combined')))} FROM top, ends"""
