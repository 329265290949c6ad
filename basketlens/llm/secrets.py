"""Secret scans through a trigram index.

From every rule's regular expression a Boolean query over trigrams is derived:
which trigrams each match must contain. An inverted index lists, for every
trigram of a dictionary, the texts which contain it (in lower case). It is written
once, sorted by trigram, and can serve any number of rule sets: the postings of
the trigrams that a set asks for are looked up and intersected, which gives the
rules that each text can match, and only these run on it. A rule without mandatory
trigrams in the dictionary runs on every text, in place.

All steps are DataFrame operations. One expression finds all trigrams of the
dictionary in one pass over a text. Texts are indexed under a 64-bit hash: two
texts with the same hash only become candidates together, the expressions
themselves decide. Candidates are counted; up to ``BROADCAST_TEXTS`` are sent to
the documents, so that no text is shuffled. Beyond that both sides are shuffled:
a hot text is then a hot join key on the documents' side, so documents are salted
by their other columns, and the list of candidates is repeated for each of
``SALTS`` salts. Both ways give the same result.

Defined cases: a null text counts as empty and has no spans; repeated rows and
rows with a null id each give a row of their own; an empty table gives an empty
result; a very long text is searched whole, in one task; spans that start together
come in the order of their rules; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import and_, or_
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.tables import whole
from basketlens.sources.landing import land

#: Strings that a part of an expression may stand for before it counts as open.
MAX_STRINGS = 64
#: Parts that the documents with one text are dealt to.
SALTS = 16
#: Candidate texts (a hash and a few names each) that are sent to all executors.
BROADCAST_TEXTS = 500_000


def either_case(word: str) -> str:
    """A pattern for an ASCII word in any mixture of cases."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: spans of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


_NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")),
                   either_case("api") + "_?" + either_case("key")])

# A run of characters of one class that is long enough is the same span whether
# the length stands in the pattern or is tested afterwards. A failing assignment
# however uses up its characters, so there the length is tested afterwards.
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)


# --- trigram queries -------------------------------------------------------
# A query is True (says nothing), a trigram, or ("and" | "or", [queries]).


def _join(kind: str, parts: list):
    idle = kind == "and"
    if not idle and any(p is True for p in parts):
        return True
    kept = list(dict.fromkeys(p if not isinstance(p, list) else tuple(p) for p in parts if p is not True))
    if not kept:
        return True
    return kept[0] if len(kept) == 1 else (kind, tuple(kept))


def _of_strings(strings: set[str]):
    """What a text holding one of the strings must contain; the weakest demands suffice."""
    demands = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    weakest = [d for d in demands if not any(other < d for other in demands)]
    return _join("or", [_join("and", sorted(d)) for d in sorted(weakest, key=sorted)])


def _characters(items) -> set[str] | None:
    """The characters of a class in lower case; None when there are many."""
    found: set[str] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            found.add(chr(value).lower())
        else:
            return None
    return found if len(found) <= 8 else None


def _sequence(nodes) -> tuple[set[str] | None, object]:
    """The strings that a sequence can be, or None; and the query all its matches meet."""
    query: object = True
    strings, whole_known = {""}, True
    for kind, value in nodes:
        exact, inner, ends = None, True, False
        if kind is sre.LITERAL:
            exact = {chr(value).lower()}
        elif kind is sre.IN:
            exact = _characters(value)
        elif kind is sre.SUBPATTERN:
            exact, inner = _sequence(value[3])
        elif kind is sre.BRANCH:
            parts = [_sequence(x) for x in value[1]]
            if all(p[0] is not None for p in parts):
                exact = set().union(*(p[0] for p in parts))
            inner = _join("or", [p[1] for p in parts])
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = value
            exact, inner = _sequence(body)
            if low == 0:
                inner = True
                exact = exact | {""} if exact is not None and high == 1 else None
            elif (low, high) != (1, 1):
                ends = True  # once for certain, then more of it
        elif kind is sre.AT:
            continue
        if exact is None:
            query = _join("and", [query, inner])
        together = exact and {a + b for a, b in product(strings, exact)}
        if exact is None or len(together) > MAX_STRINGS:
            query = _join("and", [query, _of_strings(strings)])
            strings, whole_known = (exact if exact and len(exact) <= MAX_STRINGS else {""}), False
        else:
            strings = together
        if ends:
            query = _join("and", [query, _of_strings(strings)])
            strings, whole_known = {""}, False
    query = _join("and", [query, _of_strings(strings)])
    return (strings if whole_known else None), query


def trigram_query(pattern: str):
    """The Boolean query over lower-case trigrams that every match of ``pattern`` meets."""
    return _sequence(_parser.parse(pattern))[1]


def trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _holds(query, grams: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(grams, query)
    return reduce(and_ if query[0] == "and" else or_, [_holds(q, grams) for q in query[1]])


def weakened(query, grams: set[str] | frozenset[str]):
    """The query as far as the trigrams ``grams`` can answer it."""
    if query is True:
        return True
    if isinstance(query, str):
        return query if query in grams else True
    return _join(query[0], [weakened(q, grams) for q in query[1]])


# --- index, candidates, verification ----------------------------------------


@dataclass(frozen=True)
class Index:
    """Postings (gram, text_key), sorted by gram in each file, and the trigrams they cover."""

    postings: DataFrame
    grams: frozenset[str]


def wanted_trigrams(rules: tuple[Rule, ...]) -> set[str]:
    """The trigrams that the rules' queries name."""
    return set().union(*(trigrams(trigram_query(r.pattern)) for r in rules))


def _finder(grams: set[str] | frozenset[str]) -> str:
    """A pattern whose group 1 is, at every place of a text, the trigram of ``grams`` that starts there.

    Three classes turn most places away before the tree of trigrams is walked.
    """
    def char(c: str) -> str:
        return f"\\x{{{ord(c):x}}}"

    def any_of(chars) -> str:
        return "[" + "".join(map(char, sorted(chars))) + "]"

    tree: dict[str, dict[str, set[str]]] = {}
    for a, b, c in sorted(grams):
        tree.setdefault(a, {}).setdefault(b, set()).add(c)
    branches = [
        char(a) + "(?:" + "|".join(char(b) + any_of(thirds) for b, thirds in seconds.items()) + ")"
        for a, seconds in tree.items()
    ]
    gate = "".join(any_of({g[i] for g in grams}) for i in range(3))
    return f"(?={gate})(?=({'|'.join(branches)}))"


def build_index(docs: DataFrame, grams: set[str] | frozenset[str], text: str = "text") -> Index:
    """The index of the trigrams ``grams`` (in lower case) over all texts, written to the shared folder."""
    key = F.xxhash64(whole(text)).alias("text_key")
    none = F.array().cast("array<string>")
    held = F.regexp_extract_all(F.lower(whole(text)), F.lit(_finder(grams)), F.lit(1)) if grams else none
    postings = docs.select(F.explode(F.array_distinct(held)).alias("gram"), key).sortWithinPartitions("gram")
    return Index(land(postings, "postings"), frozenset(grams))


def candidates(index: Index, rules: tuple[Rule, ...]) -> DataFrame:
    """(text_key, kinds): for each text the kinds whose trigram query its postings meet.

    Kinds that the index says nothing about are not among them.
    """
    queries = {r.kind: weakened(trigram_query(r.pattern), index.grams) for r in rules}
    asked = {kind: q for kind, q in queries.items() if q is not True}
    wanted = sorted(set().union(*map(trigrams, asked.values())))
    found = index.postings.where(F.col("gram").isin(wanted))
    grouped = found.groupBy("text_key").agg(F.collect_set("gram").alias("grams"))
    kinds = [F.when(_holds(q, F.col("grams")), kind) for kind, q in asked.items()]
    compact = F.array_compact(F.array(*kinds)) if kinds else F.array().cast("array<string>")
    return grouped.select("text_key", compact.alias("kinds")).where(F.size("kinds") > 0)


def _spans(pieces: Column, matches: Column, groups: Column, rule: Rule, place: int) -> Column:
    """Spans from what lies between the matches, the matches, and their tested group."""
    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>").alias("spans"),
    )

    def step(acc, x):
        begin = acc["at"] + F.length(x["p"])
        end = begin + F.length(x["m"])
        span = F.struct(
            begin.cast("long").alias("start"), F.lit(place).alias("place"),
            F.lit(rule.kind).alias("kind"), end.cast("long").alias("end"),
        )
        passes = F.length(x["g"]) >= rule.least
        return F.struct(
            end.cast("long").alias("at"),
            F.when(passes, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    zipped = F.zip_with(
        F.arrays_zip(matches.alias("m"), groups.alias("g")),
        F.slice(pieces, F.lit(1), F.size(matches)),
        lambda a, p: F.struct(p.alias("p"), a["m"].alias("m"), a["g"].alias("g")),
    )
    return F.aggregate(zipped, start, step, lambda acc: acc["spans"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
         spans: str = "secret_spans", index: Index | None = None) -> DataFrame:
    """The rows of ``docs`` with the column ``spans``: (start, place, kind, end) in order.

    Starts and ends count code points, the end is exclusive; ``place`` is the rule's
    number. A column which is already called ``spans`` gives way. An ``index`` must
    cover all texts of ``docs`` and may cover more; without one it is built.
    """
    index = index or build_index(docs, wanted_trigrams(rules), text)
    names = [n for n in docs.columns if n != spans]
    key, salt, flags = "__text_key", "__salt", "__kinds"
    rows = docs.withColumn(key, F.xxhash64(whole(text)))
    found = land(candidates(index, rules), "candidates").select(F.col("text_key").alias(key), F.col("kinds").alias(flags))
    if found.count() <= BROADCAST_TEXTS:
        rows = rows.join(F.broadcast(found), key, "left")
    else:
        # Any salt is right, as candidates have all of them. Maps cannot be hashed.
        others = [F.col(f"`{n}`") for n, kind in docs.dtypes if n != text and "map<" not in kind and kind != "variant"]
        rows = rows.withColumn(salt, F.pmod(F.xxhash64(*others), F.lit(SALTS)).cast("int") if others else F.lit(0))
        found = found.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.join(found, [key, salt], "left")
    for i, r in enumerate(rules):
        source = whole(text)
        if weakened(trigram_query(r.pattern), index.grams) is not True:
            source = F.when(F.array_contains(flags, r.kind), source)
        rows = rows.withColumn(f"__m{i}", F.regexp_extract_all(source, F.lit(r.pattern), F.lit(0)))
    parts = []
    for i, r in enumerate(rules):
        m = F.col(f"__m{i}")
        found = _spans(
            F.split(whole(text), r.pattern, -1),
            m,
            F.regexp_extract_all(whole(text), F.lit(r.pattern), F.lit(r.group)) if r.group else m,
            r, i,
        )
        none = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
        parts.append(F.when(F.size(m) > 0, found).otherwise(none))
    return rows.select(*[F.col(f"`{n}`") for n in names], F.array_sort(F.concat(*parts)).alias(spans))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``[kind]``; columns and rows stay.

    Overlapping spans become one mark which names the first of them. A null text
    stays null.
    """
    names, spans = docs.columns, "__secret_spans"
    found = scan(docs, rules, text, spans)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substr(F.col(f"`{text}`"), acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]")))
            .otherwise(acc["out"]).alias("out"),
        )

    clean = F.aggregate(
        spans, start, step,
        lambda acc: F.concat(acc["out"], F.substr(F.col(f"`{text}`"), acc["at"].cast("int") + 1, F.lit(2**31 - 1))),
    )
    mended = F.when(F.size(spans) > 0, clean).otherwise(F.col(f"`{text}`"))
    return found.select(*[mended.alias(text) if n == text else F.col(f"`{n}`") for n in names])


def secrets_query(docs: DataFrame) -> DataFrame:
    found = scan(docs.select("doc_id", "text"))
    bases = [r.kind for r in RULES if r.base]
    base = F.filter("secret_spans", lambda s: s["kind"].isin(bases))

    def number(kind: str) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")

    kinds = [number(k).alias(f"n_{k}") for k in bases]
    return found.select(
        "doc_id", *kinds, F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("secret_spans")).alias("spans"),
    )


def secrets_sql() -> str:
    parts = []
    for place, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""
SELECT row, {place} AS place, '{r.kind}' AS kind, {str(r.base).lower()} AS base,
  unnest(list_transform(range(1, len(m) + 1), lambda i: {{
    'start': (list_sum(list_transform(s[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT,
    'n': length(m[i]), 'g': length(g[i])}})) AS span, {r.least} AS least
FROM (SELECT row, regexp_extract_all(text, '{p}', 0) AS m,
  regexp_extract_all(text, '{p}', {r.group}) AS g,
  string_split_regex(text, '{p}') AS s FROM d)""")
    shown = "kind || ':' || span.start || ':' || (span.start + span.n)"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
s AS MATERIALIZED (SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE span.g >= least),
t AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign,
  count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg({shown}, ',' ORDER BY span.start, place) FILTER (base) AS base,
  string_agg({shown}, ',' ORDER BY span.start, place) AS spans FROM s GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN t USING (row)"""
