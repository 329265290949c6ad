"""URL filters whose block decisions reach all aliases of a page.

Rules name a host, with all its subdomains, and the start of a path; of the rules
that fit a URL the longest decides. Pages say by redirects and canonical links
which other URLs they are aliases of. Connected components over these links are
classes of aliases, and a URL without a rule is blocked if a rule blocks any URL
of its class, given as a page or only as a link's target. An explicit rule comes
first: a URL that a rule allows stays allowed in a blocked class, and does not
free the others.

Links are the targets of ``<link rel=canonical>`` and ``<meta http-equiv=refresh>``
outside comments, scripts and styles, resolved against the page's URL, and any
rows of a table of redirects. A URL is compared by scheme and host in lower case,
path and query; the fragment is no part of it.

Only pages that may have a link are parsed. Components and decisions are joins in
which the edges or pages of one URL are spread by a salt, so neither a URL that a
third of all pages point to nor one that a third of all pages have is one task's.

Defined cases: a null URL, or one without ``://``, has an empty host and path, no
rule and no alias, and is allowed; a null or empty html has no links; a very long
html is scanned once, in time proportional to its length; a target that is no URL
is passed over. Rows that repeat, or share an id or a null id, are judged each by
its own URL. Rules of equal length that fit one URL: the longer host decides,
then block. No pages give no rows. Columns but page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence
from string import ascii_lowercase, ascii_uppercase
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.components import components, with_least
from basketlens.llm.tables import whole
from basketlens.sources.landing import land

# The rules of the query, as verdict, host and path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_SKIP_OR_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1|\Z)|<(link|meta)\b([^<>]*)>", re.DOTALL | re.IGNORECASE
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])([\w-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_REFRESH = re.compile(r"""[\s\d.]*[;,]?\s*url\s*=\s*["']?([^"']*)""", re.IGNORECASE)


def link_targets(url: str, html: str) -> list[str]:
    """Absolute URLs which a page declares itself an alias of."""
    found = []
    for m in _SKIP_OR_TAG.finditer(html):
        if not m[2]:
            continue
        values = {a[1].lower(): entities.unescape(a[2] or a[3] or a[4] or "") for a in _ATTRIBUTE.finditer(m[3])}
        href = None
        if m[2].lower() == "link":
            if "canonical" in values.get("rel", "").lower().split():
                href = values.get("href")
        elif values.get("http-equiv", "").strip().lower() == "refresh":
            refresh = _REFRESH.match(values.get("content", ""))
            href = refresh and refresh[1]
        if href and href.strip():
            try:
                target = urljoin(url, href.strip())
            except ValueError:
                continue
            if "://" in target:
                found.append(target)
    return found


def _lower(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case."""
    return _lower(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def alias_key(url: Column) -> Column:
    """A digest of the URL as it is compared; null for what is no URL."""
    rest = F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^#]*)", 1)
    key = F.concat(_lower(F.substring_index(url, "://", 1)), F.lit("://"), host_of(url), rest)
    return F.when(F.instr(url, "://") > 0, F.md5(key))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule as host and path, its verdict), null where no rule fits.

    The rules become one expression, tried from the longest on: for a list that
    the driver holds, of some hundred rules.
    """
    order = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1]), r[0] != "block", r))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decided, rule_host, rule_path in reversed(order):
        fits = (
            ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        )
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(decided)).otherwise(verdict)
    return name, verdict


def page_links(pages: DataFrame) -> DataFrame:
    """(source, target): URLs joined by a redirect or canonical link in a page's html."""
    may = pages.select("url", "html").where(
        F.contains("url", F.lit("://")) & F.col("html").rlike("(?i)canonical|refresh")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [
                (url, target)
                for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for target in link_targets(url, html)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)], names=["source", "target"]
            )

    return may.mapInArrow(run, "source string, target string")


def blocked_aliases(links: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(node): keys of the linked URLs that have no rule and an alias which a rule blocks."""

    def end(name: str) -> Column:
        url = F.col(name)
        verdict = longest_rule(host_of(url), path_of(url), rules)[1]
        return F.struct(alias_key(url).alias("node"), verdict.alias("verdict"))

    ends = links.select(end("source").alias("s"), end("target").alias("t"))
    edges = land(ends.where("s.node <> t.node").distinct(), "alias-links")
    classes = components(edges.select(F.col("s.node").alias("a"), F.col("t.node").alias("b")))
    nodes = edges.select(F.inline(F.array("s", "t"))).distinct()
    members = nodes.join(classes, "node", "left").select(
        "node", "verdict", F.coalesce("root", "node").alias("root"),
        F.when(F.col("verdict") == "block", 0).otherwise(1).alias("free"),
    )
    judged = with_least(members, "root", "free", "node", "class_free")
    return judged.where("class_free = 0 AND verdict IS NULL").select("node")


def url_filter(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page (page_id, url, html).

    ``redirects`` (source, target) adds links which are not in the html, such as
    those that a crawler met.
    """
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("source", "target"))
    blocked = land(blocked_aliases(links, rules), "blocked-aliases")
    url = whole("url")
    named = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), alias_key(url).alias("node"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    judged = named.select("page_id", "host", "path", "node", rule.alias("rule"), verdict.alias("verdict"))
    ruled = judged.where("verdict IS NOT NULL OR node IS NULL").withColumn("verdict", F.coalesce("verdict", F.lit("allow")))
    if blocked.isEmpty():
        return judged.withColumn("verdict", F.coalesce("verdict", F.lit("allow"))).drop("node")
    # A page and a blocked URL of one key meet by the key; pages of one URL are spread by their id.
    marks = blocked.select(
        F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"), F.lit("").alias("host"),
        F.lit("").alias("path"), "node", F.lit(0).alias("free"), F.lit(False).alias("page"),
    )
    open_ = judged.where("verdict IS NULL AND node IS NOT NULL").select(
        "page_id", "host", "path", "node", F.lit(1).alias("free"), F.lit(True).alias("page")
    )
    met = with_least(open_.unionByName(marks), "node", "free", "page_id", "least_free").where("page")
    aliases = met.select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
        F.when(F.col("least_free") == 0, "block").otherwise("allow").alias("verdict"),
    )
    return ruled.drop("node").unionByName(aliases)


def url_filter_query(pages: DataFrame) -> DataFrame:
    return url_filter(pages)


def _parts_sql(url: str) -> str:
    rest = f"(CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END)"
    host = f"translate(regexp_extract({rest}, '^[^/?#]*'), '{ascii_uppercase}', '{ascii_lowercase}')"
    query = f"regexp_extract({rest}, '^[^/?#]*([^#]*)', 1)"
    key = (
        f"CASE WHEN instr({url}, '://') > 0 THEN translate(split_part({url}, '://', 1), '{ascii_uppercase}', "
        f"'{ascii_lowercase}') || '://' || {host} || {query} END"
    )
    return f"{host} AS host, regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) AS path, {key} AS node"


_RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
_BEST_SQL = """(SELECT {} FROM rules r WHERE (x.host = r.h OR x.host LIKE '%.' || r.h) AND starts_with(x.path, r.p)
  ORDER BY len(r.h) + len(r.p) DESC, len(r.h) DESC, r.v DESC LIMIT 1)"""

# Of links, those with an absolute URL between double quotes, attributes in this order;
# tests compare all others with a plain computation.
URL_FILTER_SQL = f"""
WITH RECURSIVE rules(v, h, p) AS (VALUES {_RULES_SQL}),
tags AS (SELECT url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'),
  '(?i)<(?:link rel="canonical" href|meta http-equiv="refresh" content)="[^"<>]*"')) AS tag
  FROM pages WHERE contains(url, '://') AND html IS NOT NULL),
links AS (SELECT url AS source, regexp_extract(tag, '"(?:[0-9]+; *url=)?([a-z]+://[^"]*)"', 1) AS target FROM tags),
urls AS (SELECT DISTINCT url FROM (SELECT source AS url FROM links UNION ALL SELECT target FROM links
  UNION ALL SELECT coalesce(url, '') FROM pages)),
named AS (SELECT url, {_parts_sql("url")} FROM urls),
judged AS (SELECT *, {_BEST_SQL.format("r.h || r.p")} AS rule, {_BEST_SQL.format("r.v")} AS verdict FROM named x),
edges AS (SELECT s.node AS a, t.node AS b FROM links JOIN named s ON s.url = source JOIN named t ON t.url = target),
pairs AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reached(node) AS (SELECT node FROM judged WHERE verdict = 'block'
  UNION SELECT b FROM reached JOIN pairs ON a = node)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN node IN (SELECT node FROM reached) THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT page_id, coalesce(url, '') AS url FROM pages) JOIN judged USING (url)"""
