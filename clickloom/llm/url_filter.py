"""URL filter: rules of hosts and paths, and a list of hosts, behind Bloom filter cascades.

The host stands after the first `://` up to `/`, `?`, `#` or the end, with A-Z lower-cased; the
path follows up to `?`, `#` or the end. A null url, and one without `://`, has neither. A rule is
a host and a path; it fits its host and all subdomains where the url's path starts with the
rule's. The longest rule wins (on a tie that of the longer host; of one rule listed for both
verdicts, block). Without a rule a page is blocked if its host, or a domain above it, is on the
list of hosts, else allowed.

Rules have few shapes: labels of the host and characters of the path. For each shape of a rule a
url can ask for one key only, its last labels and the first characters of its path. All such keys
of all pages are the universe of one cascade per verdict and one for the list of hosts, so each
url is judged by bits in its own row: no join, no shuffle of rows. Building the cascades shuffles
distinct keys only, so a frequent host costs one row a task.

Rows are judged one by one: repeated rows repeat, an empty table gives an empty result, and extra
columns are carried along whatever their names. Empty hosts fit no rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm import cascade
from clickloom.llm.text import lower_ascii
from clickloom.storage import materialize

#: Fixed rules of the query: host, path, verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Words that put a host on the list, where they stand alone between dots and hyphens.
BAD_WORDS = ["adult", "bet", "casino", "escort", "payday", "pills", "porn", "spam", "viagra", "warez", "xxx"]
MOST_SHAPES = 1000


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_hosts(hosts: DataFrame, words: list[str]) -> DataFrame:
    """The domains among `hosts` (`host`) with a bad word in their own first label."""
    bad = rf"^([^.]*-)?({'|'.join(words)})(-[^.]*)?$"
    labels = F.col("_labels")
    last = F.array_max(F.transform(labels, lambda x, i: F.when(x.rlike(bad), i)))
    cut = hosts.select(F.split("host", r"\.").alias("_labels")).withColumn("_last", last).where("_last IS NOT NULL")
    return cut.select(F.array_join(F.slice(labels, F.col("_last") + 1, F.size(labels) - F.col("_last")), ".").alias("host")).distinct()


def shapes_of(rules: DataFrame) -> list[tuple[int, int]]:
    """The distinct label counts and path lengths of `rules` (`host, path`)."""
    found = rules.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars")).distinct()
    shapes = sorted((r["labels"], r["chars"]) for r in found.limit(MOST_SHAPES + 1).collect())
    if len(shapes) > MOST_SHAPES:
        raise ValueError(f"rules of more than {MOST_SHAPES} shapes: each url would ask for as many keys")
    return shapes


def asked_keys(host: str, path: str, shapes: list[tuple[int, int]]) -> Column:
    """The keys that a url asks for, one per shape, null where it is too short for the shape."""

    def key(labels: int, chars: int) -> Column:
        long = (F.size(F.split(host, r"\.")) >= labels) & (F.length(path) >= chars) & (F.col(host) != "")
        suffix = F.substring_index(host, ".", -labels)
        return F.when(long, F.struct(F.length(suffix).alias("host_size"), F.concat(suffix, F.substring(path, 1, chars)).alias("key")))

    kind = "array<struct<host_size:int,key:string>>"
    return F.array(*[key(*shape) for shape in shapes]).cast(kind) if shapes else F.array().cast(kind)


def hashed(df: DataFrame, key: Column) -> DataFrame:
    return df.select(F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(1), key).alias("k2"))


def judge(pages: DataFrame, rules: DataFrame, hosts: DataFrame, url: str = "url") -> DataFrame:
    """`all` (the row of `pages`), `host`, `path`, `rule`, `verdict` and `listed`, the listed domain that fits.

    `rules` are `host, path, verdict` (allow or block), `hosts` the blocked domains (`host`).
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.struct("*").alias("all"), host.alias("host"), path.alias("path"))
    listed = rules.select("host", "path", "verdict").unionByName(
        hosts.select("host", F.lit("").alias("path"), F.lit("listed").alias("verdict"))
    )
    shapes = shapes_of(listed)
    asked = rows.withColumn("_asked", asked_keys("host", "path", shapes))
    keys = hashed(asked.select(F.explode("_asked.key").alias("key")).where("key IS NOT NULL"), F.col("key"))
    universe = materialize(keys.distinct(), "url-keys")
    asked = asked.withColumns({
        "_k1": F.transform("_asked", lambda x: F.when(x.isNotNull(), F.xxhash64(x["key"]))),
        "_k2": F.transform("_asked", lambda x: F.when(x.isNotNull(), F.xxhash64(F.lit(1), x["key"]))),
    })
    cascades = {
        f"_{kind}": cascade.build(universe, hashed(listed.where(F.col("verdict") == kind), F.concat("host", "path")))
        for kind in ("allow", "block", "listed")
    }
    asked = cascade.member(asked, "_k1", "_k2", cascades)

    def longest(*named: str) -> Column:
        """The longest key among the hits of these kinds; `named` last in order wins on one key."""
        marked = F.arrays_zip("_asked", *[f"_{kind}" for kind in dict.fromkeys(named)])
        hits = F.filter(marked, lambda x: F.greatest(*[x[f"_{kind}"] for kind in named], F.lit(False)))
        verdict = lambda x: F.when(x[f"_{named[-1]}"], F.lit(named[-1])).otherwise(F.lit(named[0]))
        return F.array_max(F.transform(hits, lambda x: F.struct(
            F.length(x["_asked"]["key"]).alias("size"), x["_asked"]["host_size"].alias("host_size"), x["_asked"]["key"].alias("key"), verdict(x).alias("verdict"),
        )))

    best = asked.select("all", "host", "path", longest("allow", "block").alias("_rule"), longest("listed", "listed").alias("_on"))
    verdict = F.coalesce("_rule.verdict", F.when(F.col("_on").isNotNull(), "block").otherwise("allow"))
    return best.select("all", "host", "path", F.col("_rule.key").alias("rule"), verdict.alias("verdict"), F.col("_on.key").alias("listed"))


def urls_query(pages: DataFrame) -> DataFrame:
    host, _ = host_and_path(F.col("url"))
    rules = pages.sparkSession.createDataFrame(RULES, "host string, path string, verdict string")
    hosts = listed_hosts(pages.select(host.alias("host")).distinct(), BAD_WORDS)
    return judge(pages.select("page_id", "url"), rules, hosts).select("all.page_id", "host", "path", "rule", "verdict")


URLS_SQL = rf"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), h AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p
), r AS (
  SELECT *, CASE
    WHEN regexp_matches(host, '(^|\.)example\.org$') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN regexp_matches(host, '(^|\.)example\.org$') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN regexp_matches(host, '(^|\.)com$') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN regexp_matches(host, '(^|\.)com$') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN regexp_matches(host, '(^|\.)org$') AND starts_with(path, '/') THEN 'org/' END AS rule FROM h
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host, '(^|[.-])({'|'.join(BAD_WORDS)})($|[.-])') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
