"""URL filters: host-suffix and path-prefix expressions against a rule list.

Each URL is expanded into expressions ``host suffix + path prefix``, as many labels and characters
long as some rule's. They meet the rules in an equi-join on the first 32 bits of their SHA-256;
equal prefixes are confirmed on the full digest, and the longest rule decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.columns import q
from salesloom.llm.common import LOWER, UPPER, any_names, ascii_lower, others, table
from salesloom.operators.joins import lookup_join

#: (verdict, host, path)
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
PREFIX_DIGITS = 8
_LOWER = str.maketrans(UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#``; path: then up to ``?`` or ``#``.

    Both are empty for NULL and for text without ``://``.
    """
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


@any_names
def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """All rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` are (verdict, host, path); a rule fits its host and all subdomains if the path
    starts with the rule's. The longest text ``host + path`` wins, then the longer host, then
    ``block``. Without a rule ``rule`` is NULL and ``verdict`` is ``default``. Repeated rows stay
    repeated; NULL and empty URLs get no rule (they have no host); an empty table gives an empty
    one. Columns of ``pages`` named like the four new ones are replaced.

    One decision is made per distinct URL, so a URL that holds many rows costs one expansion, and
    the decisions are joined back with the skew-safe lookup join.
    """
    made = ["host", "path", "rule", "verdict"]
    rows = pages.select(*others(pages, made), q(url).alias("_url"))
    host, path = host_and_path(F.col("_url"))
    labels, lengths = _shapes(rules)
    hosts = F.array_distinct(
        F.array(*[F.substring_index(F.col("_host"), ".", -k) for k in labels])
    )
    paths = [F.when(F.length("_path") >= n, F.substring(F.col("_path"), 1, n)) for n in lengths]
    expressions = (
        rows.select("_url")
        .where("_url IS NOT NULL")
        .distinct()
        .select("_url", host.alias("_host"), path.alias("_path"))
        .where("_host <> ''")
        .select("_url", F.explode(hosts).alias("_suffix"), "_path")
        .select("_url", "_suffix", F.explode(F.array_compact(F.array(*paths))).alias("_start"))
        .select("_url", F.sha2(F.concat("_suffix", "_start"), 256).alias("_digest"))
        .withColumn("_short", F.substring("_digest", 1, PREFIX_DIGITS))
    )
    met = lookup_join(expressions, _rule_table(pages.sparkSession, rules), [("_short", "_rule_short")])
    best = F.struct(F.length("_rule"), F.length("_rule_host"), F.col("_rule_verdict") == "block")
    decided = (
        met.where("_digest = _rule_digest")
        .groupBy(F.col("_url").alias("_of"))
        .agg(F.max_by(F.struct("_rule", "_rule_verdict"), best).alias("_best"))
    )
    joined = lookup_join(rows, decided, [("_url", "_of")], "left")
    verdict = F.coalesce(F.col("_best._rule_verdict"), F.lit(default))
    return joined.select(
        *others(pages, made),
        host.alias("host"),
        path.alias("path"),
        F.col("_best._rule").alias("rule"),
        verdict.alias("verdict"),
    )


def _shapes(rules) -> tuple[list[int], list[int]]:
    """Numbers of labels and lengths of paths that occur in the rules."""
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict must be 'allow' or 'block', not {verdict!r}")
        if not host or set("/?#") & set(host) or path[:1] not in ("", "/"):
            raise ValueError(f"no rule: {host!r}, {path!r}")
    labels = sorted({host.count(".") + 1 for _, host, _ in rules})
    return labels or [1], sorted({len(path) for _, _, path in rules}) or [0]


def _rule_table(spark: SparkSession, rules) -> DataFrame:
    rows = [(v, h.translate(_LOWER), h.translate(_LOWER) + p) for v, h, p in rules]
    frame = spark.createDataFrame(rows, "_rule_verdict string, _rule_host string, _rule string")
    digest = F.sha2("_rule", 256)
    return frame.withColumns(
        {"_rule_digest": digest, "_rule_short": F.substring(digest, 1, PREFIX_DIGITS)}
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_urls(table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0
    THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), named AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM parts
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM named
"""
