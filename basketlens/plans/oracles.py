"""SQL over the test tables which gives what the named analyses must give."""

from __future__ import annotations

# The six product types of the test tables.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

LINES = """
lines AS (
  SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity)) AS row_id,
         CASE WHEN l_linestatus = 'F' THEN 'female'
              WHEN l_linestatus IS NOT NULL THEN 'male' END AS gender,
         CAST(l_quantity AS INTEGER) AS age,
         CASE WHEN c_acctbal >= 5000 THEN 'yes' WHEN c_acctbal IS NOT NULL THEN 'no' END
           AS is_member,
         p_type AS category,
         n_name AS province,
         l_extendedprice / l_quantity AS unit_price,
         l_discount, l_tax
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
)"""

PURCHASES = f"""WITH {LINES},
purchases AS (
  SELECT row_id, gender, age, is_member, category, province, unit_price
  FROM lines
  WHERE gender IS NOT NULL AND age IS NOT NULL AND is_member IS NOT NULL
    AND category IS NOT NULL AND province IS NOT NULL
    AND unit_price IS NOT NULL AND NOT isnan(unit_price)
)"""

DIRTY = f"""WITH {LINES},
dirty AS (
  SELECT row_id, gender,
         CASE WHEN l_discount = 0.1 THEN 'abc' WHEN l_discount = 0.09 THEN NULL
              ELSE CAST(age AS VARCHAR) END AS age,
         CASE WHEN l_tax = 0.08 THEN NULL ELSE is_member END AS is_member,
         category, province,
         CASE WHEN l_tax = 0.07 THEN CAST('NaN' AS DOUBLE) ELSE unit_price END AS unit_price
  FROM lines
),
typed AS (
  SELECT row_id, gender,
         TRY_CAST(trunc(TRY_CAST(age AS DOUBLE)) AS INTEGER) AS age,
         is_member, category, province, unit_price
  FROM dirty
)"""

COMPLETE = """gender IS NOT NULL AND age IS NOT NULL AND is_member IS NOT NULL
  AND category IS NOT NULL AND province IS NOT NULL
  AND unit_price IS NOT NULL AND NOT isnan(unit_price)"""

BAND = """CASE WHEN age < 25 THEN '[0,25)' WHEN age < 35 THEN '[25,35)'
  WHEN age < 45 THEN '[35,45)' WHEN age >= 45 THEN '[45,inf)' END"""

PIVOT = ",\n".join(
    f"CAST(sum(CASE WHEN category = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS \"{c}\""
    for c in CATEGORIES
)

CLEAN_ROWS = f"""{DIRTY}
SELECT row_id, gender, age, is_member, category, province, unit_price
FROM typed WHERE {COMPLETE}"""


def _stats(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS n,
  round(avg({column}), 4) AS mean, round(stddev_samp({column}), 4) AS stddev,
  CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max
FROM purchases"""


def _share(column: str, value: str) -> str:
    return f"""{PURCHASES}
SELECT count(*) FILTER (WHERE {column} = '{value}') AS n, count(*) AS total,
  round(count(*) FILTER (WHERE {column} = '{value}') * 100.0 / count(*), 2) AS share
FROM purchases"""


def _histogram(column: str) -> str:
    return f"""{PURCHASES},
b AS (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi
      FROM purchases),
counted AS (
  SELECT CAST(least(floor(({column} - lo) * 20 / (hi - lo)), 19) AS INTEGER) AS bin,
         count(*) AS n
  FROM purchases, b GROUP BY 1
),
grid AS (SELECT CAST(g AS INTEGER) AS bin FROM range(20) AS t(g))
SELECT grid.bin, round(lo + grid.bin * (hi - lo) / 20, 6) AS lower,
  round(lo + (grid.bin + 1) * (hi - lo) / 20, 6) AS upper,
  CAST(coalesce(n, 0) AS BIGINT) AS n
FROM grid CROSS JOIN b LEFT JOIN counted ON grid.bin = counted.bin"""


def _index(column: str) -> str:
    return f"""{PURCHASES}
SELECT {column}, count(*) AS n,
  CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS INTEGER) AS "index"
FROM purchases GROUP BY {column}"""


def _cuts(name: str, column: str, groups: int) -> str:
    points = ", ".join(
        f"(SELECT quantile_disc({column}, {i / groups}) FROM purchases)" for i in range(1, groups)
    )
    return f"{name} AS (SELECT DISTINCT CAST(c AS DOUBLE) AS cut FROM unnest([{points}]) AS t(c))"


def _bins(column: str, groups: int) -> str:
    return f"""{PURCHASES},
{_cuts("cuts", column, groups)},
binned AS (
  SELECT count(cut) AS bin, max(cut) AS lower_cut, v.n
  FROM (SELECT {column} AS x, count(*) AS n FROM purchases GROUP BY 1) v
  LEFT JOIN cuts ON cut <= x GROUP BY x, v.n
)
SELECT CAST(bin AS INTEGER) AS bin, lower_cut, CAST(sum(n) AS BIGINT) AS n
FROM binned GROUP BY 1, 2"""


def _rank(column: str) -> str:
    return f"""{column}_rank AS (
  SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS INTEGER) AS r,
         CAST(count(*) OVER () AS INTEGER) AS k
  FROM purchases GROUP BY {column}
)"""


# Vector slots in order: gender, member, province (one less than values each), age, price.
LAYOUT = f"""{PURCHASES},
{_rank("gender")}, {_rank("is_member")}, {_rank("province")},
{_cuts("age_cuts", "age", 4)},
{_cuts("price_cuts", "unit_price", 5)},
age_bin AS (
  SELECT x.age, count(cut) AS bin FROM (SELECT DISTINCT age FROM purchases) x
  LEFT JOIN age_cuts ON cut <= x.age GROUP BY x.age
),
price_bin AS (
  SELECT x.unit_price, count(cut) AS bin FROM (SELECT DISTINCT unit_price FROM purchases) x
  LEFT JOIN price_cuts ON cut <= x.unit_price GROUP BY x.unit_price
),
base AS (
  SELECT (SELECT max(k) - 1 FROM gender_rank) AS after_gender,
         (SELECT max(k) - 1 FROM gender_rank) + (SELECT max(k) - 1 FROM is_member_rank)
           AS after_member,
         (SELECT max(k) - 1 FROM gender_rank) + (SELECT max(k) - 1 FROM is_member_rank)
           + (SELECT max(k) - 1 FROM province_rank) AS after_province
)"""

FEATURES = f"""{LAYOUT}
SELECT row_id, r AS slot, CAST(1 AS DOUBLE) AS value
FROM purchases JOIN gender_rank USING (gender) WHERE r < k - 1
UNION ALL
SELECT row_id, after_gender + r, 1 FROM purchases JOIN is_member_rank USING (is_member), base
WHERE r < k - 1
UNION ALL
SELECT row_id, after_member + r, 1 FROM purchases JOIN province_rank USING (province), base
WHERE r < k - 1
UNION ALL
SELECT row_id, after_province, bin FROM purchases JOIN age_bin USING (age), base WHERE bin > 0
UNION ALL
SELECT row_id, after_province + 1, bin FROM purchases JOIN price_bin USING (unit_price), base
WHERE bin > 0"""

CHI_SQUARE_PARTS = f"""{LAYOUT},
slots AS (
  SELECT r AS slot, 'gender=' || gender AS feature, 'gender' AS source_column, gender AS val
  FROM gender_rank WHERE r < k - 1
  UNION ALL
  SELECT after_gender + r, 'is_member=' || is_member, 'is_member', is_member
  FROM is_member_rank, base WHERE r < k - 1
  UNION ALL
  SELECT after_member + r, 'province=' || province, 'province', province
  FROM province_rank, base WHERE r < k - 1
  UNION ALL SELECT after_province, 'age', 'age', NULL FROM base
  UNION ALL SELECT after_province + 1, 'unit_price', 'unit_price', NULL FROM base
),
counted AS (
  SELECT 'gender' AS source_column, gender AS val, category, count(*) AS n
  FROM purchases GROUP BY 2, 3
  UNION ALL SELECT 'is_member', is_member, category, count(*) FROM purchases GROUP BY 2, 3
  UNION ALL SELECT 'province', province, category, count(*) FROM purchases GROUP BY 2, 3
  UNION ALL SELECT 'age', CAST(bin AS VARCHAR), category, count(*)
  FROM purchases JOIN age_bin USING (age) GROUP BY 2, 3
  UNION ALL SELECT 'unit_price', CAST(bin AS VARCHAR), category, count(*)
  FROM purchases JOIN price_bin USING (unit_price) GROUP BY 2, 3
),
cell AS (
  SELECT slot, feature, slots.source_column, category,
         CASE WHEN slots.val IS NULL THEN counted.val
              WHEN counted.val = slots.val THEN 'in' ELSE 'out' END AS v,
         CAST(sum(n) AS DOUBLE) AS o
  FROM slots JOIN counted ON slots.source_column = counted.source_column
  GROUP BY 1, 2, 3, 4, 5
),
expected AS (
  SELECT r.slot, r.feature, r.source_column, r.v, c.category, r.o * c.o / t.o AS e
  FROM (SELECT slot, feature, source_column, v, sum(o) AS o FROM cell GROUP BY 1, 2, 3, 4) r
  JOIN (SELECT slot, category, sum(o) AS o FROM cell GROUP BY 1, 2) c ON r.slot = c.slot
  JOIN (SELECT slot, sum(o) AS o FROM cell GROUP BY 1) t ON r.slot = t.slot
)"""

CHI_SQUARE_LINES = """SELECT x.slot, x.feature, x.source_column,
  sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e) AS statistic,
  CAST((count(DISTINCT x.v) - 1) * (count(DISTINCT x.category) - 1) AS INTEGER) AS dof
FROM expected x LEFT JOIN cell ON x.slot = cell.slot AND x.v = cell.v
  AND x.category = cell.category
GROUP BY 1, 2, 3"""

CHI_SQUARE = f"""{CHI_SQUARE_PARTS}
SELECT * REPLACE (round(statistic, 6) AS statistic) FROM ({CHI_SQUARE_LINES})"""


# Logarithm of the chi-square tail by a finite sum, and for odd degrees of freedom
# the complementary error function: by its series near 0, else by its fraction.
def _log_p(key: str) -> str:
    return f"""halves AS (
  SELECT *, statistic / 2 AS h, (dof % 2) / 2.0::DOUBLE AS shift, dof // 2 AS terms FROM tested
),
tails AS (
  SELECT *, sqrt(h) AS z,
    list_sum(list_transform(range(terms),
      lambda i: exp((i + shift) * ln(h) - h - lgamma(i + shift + 1)))) AS sums
  FROM halves WHERE statistic > 0 AND dof > 0
),
logs AS (
  SELECT {key}, least(0, ln(coalesce(sums, 0) + CASE WHEN shift = 0 THEN 0 WHEN z < 2.5 THEN
    1 - 2 / sqrt(pi()) * exp(-z * z) * list_sum(list_transform(range(81),
      lambda k: exp(k * ln(2) + (2 * k + 1) * ln(z) - list_sum(
        list_transform(range(k + 1), lambda j: ln(2 * j + 1)))))) ELSE
    exp(-z * z) / sqrt(pi()) / list_reduce(list_reverse(range(1, 81)),
      lambda acc, k: z + k / 2.0 / acc, z) END)) AS log_p
  FROM tails
)"""


CHI_SELECTED = f"""{CHI_SQUARE_PARTS},
tested AS ({CHI_SQUARE_LINES}),
{_log_p("slot")},
ranked AS (
  SELECT t.slot, feature, source_column, statistic, dof, coalesce(log_p, 0) AS log_p,
    CAST(row_number() OVER (ORDER BY coalesce(log_p, 0), t.slot) AS INTEGER) AS rank
  FROM tested t LEFT JOIN logs l ON t.slot = l.slot
)
SELECT slot, feature, source_column, round(statistic, 6) AS statistic, dof,
  round(log_p, 6) AS log_p, round(1 - (1 - exp(log_p)), 9) AS p_value, rank, true AS selected
FROM ranked WHERE rank <= 10"""

CHI_COLUMNS = f"""{CHI_SQUARE_PARTS},
margins AS (
  SELECT *, sum(n) OVER (PARTITION BY source_column, val)::DOUBLE AS r,
    sum(n) OVER (PARTITION BY source_column, category)::DOUBLE AS c,
    sum(n) OVER (PARTITION BY source_column)::DOUBLE AS t
  FROM counted
),
tested AS (
  SELECT source_column, max(t) * (sum(n * n / (r * c)) - 1) AS statistic,
    CAST((count(DISTINCT val) - 1) * (count(DISTINCT category) - 1) AS INTEGER) AS dof
  FROM margins GROUP BY 1
),
{_log_p("source_column")},
ranked AS (
  SELECT source_column, statistic, dof, coalesce(log_p, 0) AS log_p, count(*) OVER () AS m,
    CAST(row_number() OVER (ORDER BY coalesce(log_p, 0), source_column) AS INTEGER) AS rank
  FROM tested LEFT JOIN logs USING (source_column)
)
SELECT source_column, round(statistic, 6) AS statistic, dof, round(log_p, 6) AS log_p, rank,
  rank <= coalesce((SELECT max(rank) FROM ranked WHERE log_p <= ln(rank * 0.05::DOUBLE / m)), 0) AS selected
FROM ranked"""

# The table which models are trained and tested on, under exact cut points of the
# training part and numbers by frequency in it.
CELLS = f"""{PURCHASES},
marked AS (
  SELECT *, substr(md5('42|' || row_id), 1, 8) >= 'b3333333' AS held_out FROM purchases
),
known AS (SELECT * FROM marked WHERE NOT held_out),
{", ".join(
    f"{c}_number AS (SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) "
    f"AS {c}_index, CAST(count(*) OVER () AS DOUBLE) AS {c}_all FROM known GROUP BY {c})"
    for c in ("gender", "is_member", "province", "category")
)},
{_cuts("age_cuts", "age", 4).replace("purchases", "known")},
{_cuts("price_cuts", "unit_price", 5).replace("purchases", "known")},
binned AS (
  SELECT *, CAST((SELECT count(*) FROM age_cuts WHERE cut <= age) AS DOUBLE) AS age_bin,
    CAST((SELECT count(*) FROM price_cuts WHERE cut <= unit_price) AS DOUBLE) AS unit_price_bin
  FROM marked
)
SELECT held_out,
  {", ".join(
    f"coalesce({c}_index, (SELECT max({c}_all) FROM {c}_number)) AS {c}_index"
    for c in ("gender", "is_member", "province")
  )}, age_bin, unit_price_bin,
  coalesce(category_index, (SELECT max(category_all) FROM category_number)) AS label,
  count(*) AS n
FROM binned {" ".join(
    f"LEFT JOIN {c}_number USING ({c})" for c in ("gender", "is_member", "province", "category")
)}
GROUP BY ALL"""

# The most frequent category of the training part as the prediction for the test part.
BASELINE = f"""{PURCHASES},
marked AS (
  SELECT *, substr(md5('42|' || row_id), 1, 8) >= 'b3333333' AS held_out FROM purchases
),
guess AS (
  SELECT category AS predicted FROM marked WHERE NOT held_out
  GROUP BY category ORDER BY count(*) DESC, category LIMIT 1
),
names AS (SELECT DISTINCT category FROM marked WHERE NOT held_out),
matrix AS (
  SELECT category, predicted, count(*) AS n FROM marked, guess
  WHERE held_out AND category IN (FROM names) GROUP BY ALL
)
SELECT category, coalesce((SELECT sum(n) FROM matrix m WHERE m.category = names.category), 0)::BIGINT
    AS n,
  round((SELECT sum(CASE WHEN category = predicted THEN n ELSE 0 END) / sum(n) FROM matrix m
    WHERE m.category = names.category), 9) AS recall,
  round((SELECT sum(CASE WHEN category = predicted THEN n ELSE 0 END) / sum(n) FROM matrix m
    WHERE m.predicted = names.category), 9) AS precision,
  round((SELECT sum(CASE WHEN category = predicted THEN n ELSE 0 END) / sum(n) FROM matrix), 9)
    AS accuracy
FROM names"""

BASELINE_AUC = f"""{PURCHASES},
marked AS (
  SELECT *, substr(md5('42|' || row_id), 1, 8) >= 'b3333333' AS held_out FROM purchases
),
known AS (SELECT * FROM marked WHERE NOT held_out),
names AS (SELECT DISTINCT category FROM known),
rates AS (
  SELECT g.gender, g.is_member, names.category, (SELECT count(*) FROM known k WHERE k.gender = g.gender
      AND k.is_member = g.is_member AND k.category = names.category)
    / (SELECT count(*) FROM known k WHERE k.gender = g.gender AND k.is_member = g.is_member) AS p
  FROM (SELECT DISTINCT gender, is_member FROM known) g, names
),
rated AS (
  SELECT r.category, p, count(*) FILTER (m.category = r.category) AS pos,
    count(*) FILTER (m.category <> r.category) AS neg
  FROM marked m JOIN rates r USING (gender, is_member) WHERE held_out AND m.category IN (FROM names)
  GROUP BY 1, 2
),
loss AS (
  SELECT avg(-ln(p)) AS log_loss FROM marked m JOIN rates r USING (gender, is_member, category) WHERE held_out
)
SELECT category, sum(pos)::BIGINT AS n,
  round(sum(pos * (neg / 2 + below)) / (sum(pos) * sum(neg)), 9) AS auc, round(max(log_loss), 9) AS log_loss
FROM (SELECT *, sum(neg) OVER (PARTITION BY category ORDER BY p) - neg AS below FROM rated), loss GROUP BY 1"""

_RULE = """CASE WHEN {gender} = 'female' AND {age} < 25 THEN 'PROMO'
  WHEN {is_member} = 'yes' THEN 'STANDARD' ELSE 'MEDIUM' END"""


def _shuffled(column: str) -> str:
    names = {c: f"c.{c}" for c in ("gender", "is_member", "age")} | {column: "m.value"}
    return f"""SELECT '{column}' AS source_column,
  sum(CASE WHEN {_RULE.format(**names)} = c.category THEN c.n * m.n ELSE 0 END)::DOUBLE
    / sum(c.n * m.n)::DOUBLE AS share
FROM c, (SELECT {column} AS value, sum(n) AS n FROM c GROUP BY 1) m"""


RULE_IMPORTANCE = f"""{PURCHASES},
c AS (SELECT gender, is_member, age, category, count(*) AS n FROM purchases GROUP BY ALL),
base AS (
  SELECT avg(CASE WHEN {_RULE.format(gender="gender", is_member="is_member", age="age")} = category
    THEN 1 ELSE 0 END) AS accuracy FROM purchases
),
shuffled AS ({" UNION ALL ".join(map(_shuffled, ("gender", "is_member", "age")))})
SELECT source_column, round(accuracy, 9) AS accuracy, round(share, 9) AS permuted_accuracy,
  round(accuracy - share, 9) AS importance
FROM shuffled, base"""

DENSITY = f"""{PURCHASES},
s AS (
  SELECT CAST(min(age) AS DOUBLE) AS lo, CAST(max(age) AS DOUBLE) AS hi, count(*) AS total,
         stddev_samp(age) * pow(count(*), -0.2) AS h
  FROM purchases
),
v AS (SELECT age AS x, count(*) AS n FROM purchases GROUP BY 1),
grid AS (
  SELECT CAST(g AS INTEGER) AS point, lo + (hi - lo) * g / 199 AS place
  FROM range(200) AS t(g), s
),
d AS (
  SELECT point, place,
         sum(n * exp(-((place - x) / h) * ((place - x) / h) / 2))
           / max(total * h * sqrt(2 * pi())) AS density
  FROM grid, v, s GROUP BY 1, 2
)
SELECT point, round(place, 9) AS x, round(density, 9) AS density,
  round(density * total * (hi - lo) / 20, 4) AS curve
FROM d, s"""

# Values shared between the two nearest nodes of a grid, and nodes that reach the
# points of the curve within five bandwidths.
PRICE_DENSITY = f"""{PURCHASES},
b AS (
  SELECT CAST(min(unit_price) AS DOUBLE) AS lo, CAST(max(unit_price) AS DOUBLE) AS hi,
    count(*) AS total, stddev_samp(unit_price) * pow(count(*), -0.2) AS h FROM purchases
),
s AS (SELECT *, (hi - lo) / 199 AS gap, ceil(4 * ((hi - lo) / 199) / h) AS between FROM b),
v AS (
  SELECT (unit_price - lo) / (gap / between) AS place, between * 199 - 1 AS final FROM purchases, s
),
halves AS (SELECT least(floor(place), final) AS node, place FROM v),
nodes AS (
  SELECT node, sum(mass) AS mass FROM (
    SELECT node, 1 - (place - node) AS mass FROM halves
    UNION ALL SELECT node + 1, place - node FROM halves) GROUP BY 1
),
grid AS (SELECT CAST(g AS INTEGER) AS point FROM range(200) AS t(g)),
d AS (
  SELECT point, sum(mass * exp(-((point * gap - node * gap / between) / h)
    * ((point * gap - node * gap / between) / h) / 2)) AS mass
  FROM grid, s, nodes WHERE point >= ceil((node * gap / between - 5 * h) / gap)
    AND point <= floor((node * gap / between + 5 * h) / gap) GROUP BY 1
)
SELECT point, round(lo + point * gap, 6) AS x,
  round(coalesce(mass, 0) / (total * h * sqrt(2 * pi())), 9) AS density,
  round(coalesce(mass, 0) / (total * h * sqrt(2 * pi())) * total * (hi - lo) / 20, 4) AS curve
FROM grid CROSS JOIN s LEFT JOIN d USING (point)"""

REPORT = f"""{PURCHASES},
c AS (SELECT category, count(*) AS n FROM purchases GROUP BY 1),
best AS (SELECT * FROM c ORDER BY n DESC, category LIMIT 1),
worst AS (SELECT * FROM c ORDER BY n, category LIMIT 1),
top_band AS (
  SELECT {BAND} AS age_band, count(*) AS n FROM purchases GROUP BY 1
  ORDER BY 2 DESC, 1 LIMIT 1
),
t AS (SELECT count(*) AS n, avg(age) AS age, avg(unit_price) AS price,
        count(*) FILTER (WHERE gender = 'female') AS female,
        count(*) FILTER (WHERE is_member = 'yes') AS members
      FROM purchases)
SELECT 'base' AS section, 'purchases' AS metric, '' AS item, CAST(n AS DOUBLE) AS value FROM t
UNION ALL SELECT 'base', 'average age', '', round(age, 2) FROM t
UNION ALL SELECT 'base', 'average unit price', '', round(price, 2) FROM t
UNION ALL SELECT 'base', 'female share', 'female', round(female * 100.0 / n, 2) FROM t
UNION ALL SELECT 'base', 'member share', 'yes', round(members * 100.0 / n, 2) FROM t
UNION ALL SELECT 'sales', 'best seller', category, n FROM best
UNION ALL SELECT 'sales', 'best seller share', category, round(best.n * 100.0 / t.n, 2)
FROM best, t
UNION ALL SELECT 'sales', 'worst seller', category, n FROM worst
UNION ALL SELECT 'sales', 'worst seller share', category, round(worst.n * 100.0 / t.n, 2)
FROM worst, t
UNION ALL SELECT 'advice', 'promote to age band', age_band || ': ' || category, top_band.n
FROM top_band, best"""

CLEAN_COUNTS = f"""{DIRTY}
SELECT count(*) AS rows_in,
  count(*) FILTER (WHERE {COMPLETE.replace("age IS", "typed.age IS")}) AS rows_kept,
  count(*) FILTER (WHERE gender IS NULL) AS missing_gender,
  count(*) FILTER (WHERE dirty_age IS NULL) AS missing_age,
  count(*) FILTER (WHERE is_member IS NULL) AS missing_is_member,
  count(*) FILTER (WHERE category IS NULL) AS missing_category,
  count(*) FILTER (WHERE province IS NULL) AS missing_province,
  count(*) FILTER (WHERE unit_price IS NULL) AS missing_unit_price,
  count(*) FILTER (WHERE typed.age IS NULL AND dirty_age IS NOT NULL) AS invalid_age,
  count(*) FILTER (WHERE isnan(unit_price)) AS invalid_unit_price
FROM typed JOIN (SELECT row_id AS id, age AS dirty_age FROM dirty) d ON row_id = d.id"""

MEMBER_AVERAGES = f"""{PURCHASES}
SELECT is_member, round(avg(unit_price), 4) AS avg_unit_price, round(avg(age), 4) AS avg_age
FROM purchases GROUP BY 1"""

CARDINALITY = f"{PURCHASES} SELECT count(DISTINCT province) AS n_distinct FROM purchases"

ORACLES: dict[str, str] = {
    "category_counts": f"{PURCHASES} SELECT category, count(*) AS n FROM purchases GROUP BY 1",
    "gender_counts": f"{PURCHASES} SELECT gender, count(*) AS n FROM purchases GROUP BY 1",
    "basic_stats": f"{PURCHASES} {_stats('age')} UNION ALL {_stats('unit_price')}",
    "running_stats": f"{PURCHASES} {_stats('age')} UNION ALL {_stats('unit_price')}",
    "member_averages": MEMBER_AVERAGES,
    "running_member_averages": MEMBER_AVERAGES,
    "top_provinces": f"""{PURCHASES}
SELECT province, count(*) AS n FROM purchases GROUP BY 1 ORDER BY n DESC, province LIMIT 10""",
    "province_cardinality": CARDINALITY,
    "running_cardinality": CARDINALITY,
    "gender_share": _share("gender", "female"),
    "member_share": _share("is_member", "yes"),
    "best_worst_category": f"""{PURCHASES},
c AS (SELECT category, count(*) AS n FROM purchases GROUP BY 1),
t AS (SELECT sum(n) AS total FROM c)
SELECT * FROM (SELECT 'best' AS rank, category, n, round(n * 100.0 / total, 2) AS share
               FROM c, t ORDER BY n DESC, category LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'worst', category, n, round(n * 100.0 / total, 2)
               FROM c, t ORDER BY n, category LIMIT 1)""",
    "age_band_counts": f"""{PURCHASES}
SELECT {BAND} AS age_band, count(*) AS n FROM purchases GROUP BY 1""",
    "top_age_band": f"""{PURCHASES}
SELECT {BAND} AS age_band, count(*) AS n FROM purchases GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "gender_category_pivot": f"{PURCHASES} SELECT gender, {PIVOT} FROM purchases GROUP BY 1",
    "gender_category_long": f"""{PURCHASES}
SELECT gender, category, count(*) AS n FROM purchases GROUP BY 1, 2""",
    "age_band_category_pivot": f"""{PURCHASES}
SELECT {BAND} AS age_band, {PIVOT} FROM purchases GROUP BY 1""",
    "age_histogram": _histogram("age"),
    "price_histogram": _histogram("unit_price"),
    "age_density": DENSITY,
    "price_density": PRICE_DENSITY,
    "insight_report": REPORT,
    "clean_purchases": CLEAN_ROWS,
    "ingest_csv": CLEAN_ROWS,
    "ingest_mixed_csv": CLEAN_ROWS,
    "clean_counts": CLEAN_COUNTS,
    "landing_counts": CLEAN_COUNTS,
    "rejected_rows": f"""{DIRTY}
SELECT t.row_id, d.age, t.is_member, concat_ws(',',
  CASE WHEN t.gender IS NULL THEN 'missing_gender' END,
  CASE WHEN d.age IS NULL THEN 'missing_age' END,
  CASE WHEN t.is_member IS NULL THEN 'missing_is_member' END,
  CASE WHEN t.category IS NULL THEN 'missing_category' END,
  CASE WHEN t.province IS NULL THEN 'missing_province' END,
  CASE WHEN t.unit_price IS NULL THEN 'missing_unit_price' END,
  CASE WHEN t.age IS NULL AND d.age IS NOT NULL THEN 'invalid_age' END,
  CASE WHEN isnan(t.unit_price) THEN 'invalid_unit_price' END) AS reasons
FROM typed t JOIN dirty d USING (row_id) WHERE reasons <> ''""",
    "label_index": _index("category"),
    "province_index": _index("province"),
    "train_test_split": f"""{PURCHASES}
SELECT row_id, CASE WHEN substr(md5('42|' || row_id), 1, 8) < 'b3333333' THEN 'train'
  ELSE 'test' END AS split
FROM purchases""",
    "stratified_split": f"""{PURCHASES},
ordered AS (
  SELECT row_id, category, count(*) OVER (PARTITION BY category) AS n,
    row_number() OVER (PARTITION BY category ORDER BY md5('42|' || row_id)) AS place FROM purchases
)
SELECT row_id, category, CASE WHEN place <= floor(n * 0.7::DOUBLE + 0.5) THEN 'train'
  ELSE 'test' END AS split
FROM ordered""",
    "hashed_slots": f"""{PURCHASES}, {_rank("province")}
SELECT CAST(CASE WHEN r < 10 THEN r
  ELSE 10 + CAST('0x' || substr(md5(province), 1, 8) AS BIGINT) % 8 END AS INTEGER) AS "index",
  count(*) AS n
FROM purchases JOIN province_rank USING (province) GROUP BY 1""",
    "cv_folds": f"""{PURCHASES}
SELECT row_id,
  CAST(CAST('0x' || substr(md5('43|' || row_id), 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold
FROM purchases""",
    "age_quantile_bins": _bins("age", 4),
    "price_quantile_bins": _bins("unit_price", 5),
    "onehot_province": f"""{PURCHASES}, {_rank("province")}
SELECT row_id, r AS slot, CAST(1 AS DOUBLE) AS value
FROM purchases JOIN province_rank USING (province) WHERE r < k - 1""",
    "feature_matrix": FEATURES,
    "chi2_features": CHI_SQUARE,
    "chi2_selected": CHI_SELECTED,
    "training_cells": CELLS,
    "chi2_columns": CHI_COLUMNS,
    "baseline_scores": BASELINE,
    "baseline_auc": BASELINE_AUC,
    "rule_importance": RULE_IMPORTANCE,
}
