"""URL filters: pattern rules indexed by their rarest literal token, in DataFrame functions alone.

A rule's literal tokens are the runs of ASCII letters and digits that stand whole in every url it can match. Of these,
the one in the fewest urls is the rule's key in the index; rules without one have the empty key, which every url asks
for. A url's own tokens fetch its candidates, and only their regular expressions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: rules of a domain and its subdomains and the start of a path: (action, host and path)
PLACES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: patterns for all other urls: words of pages that no corpus wants, and places without an article
PATTERNS = ("^adult^", "^porn^", "^xxx^", "^casino^", "^poker^", "^bets^", "^betting^", "^pills^", "^viagra^", "^spam^", "^ads^", "^adserver^", "^tracker^", "^wp-login.php", "^cgi-bin^", "@@^robots.txt|")
#: bytes of rules that are broadcast; more are joined by shuffles
BROADCAST_BYTES = 16 << 20
#: parts of a url token's rows in such a join
SALTS = 16


def lowered(x: Column) -> Column:
    return F.translate(x, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for urls without ://."""
    place = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, place, k), F.lit(""))
    return lowered(part(1)), part(2)


def tokens(text: Column) -> Column:
    """The distinct tokens of a lower-cased url, and the empty one."""
    return F.array_union(F.array(F.lit("")), F.coalesce(F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0)), F.array().cast("array<string>")))


def rule_table(spark: SparkSession, places=PLACES, patterns=PATTERNS) -> DataFrame:
    """(rule, action, place) from (action, host and path) pairs and pattern strings."""
    rows = [F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"), F.lit(True).alias("place")) for action, rule in places]
    rows += [F.struct(F.lit(x.removeprefix("@@")).alias("rule"), F.lit("allow" if x.startswith("@@") else "block").alias("action"), F.lit(False).alias("place")) for x in patterns]
    return spark.range(1).select(F.inline(F.array(*rows))) if rows else spark.range(0).select(F.lit("").alias("rule"), F.lit("").alias("action"), F.lit(True).alias("place"))


def compiled(rules: DataFrame) -> DataFrame:
    """rule, action, place, number, regex, words. Of the rules that fit a url the one of the highest number decides.

    A place (host and path) fits its host and all subdomains where the path starts with the rule's, and beats all
    patterns; the longest place wins, of equal ones block. A pattern is held against the whole lower-cased url: `*` stands
    for any characters, `^` for one that is no ASCII letter or digit or for the end, `||` in front for the start of the
    host or of a domain in it, `|` for the url's start or end; patterns that allow beat those that block. Rules that are
    null or empty are left out, repeated ones count once. Numbers come from one sort of all rules, in one task: rules
    are a parameter.
    """
    rules = rules.select(F.col("rule").cast("string").alias("rule"), F.col("action").cast("string").alias("action"), F.coalesce(F.col("place"), F.lit(False)).alias("place")).where("rule <> ''").distinct()
    front, end = F.regexp_extract("rule", r"^\|{0,2}", 0), F.regexp_extract("rule", r"[^|]\|$", 0) != ""
    body = lowered(F.when(end, F.expr("substr(rule, 1, length(rule) - 1)")).otherwise(F.col("rule")))
    body = F.expr("substr(body, length(front) + 1)")
    escaped = r"([\x00-\x29\x2b-\x2f\x3a-\x40\x5b-\x5d\x5f\x60\x7b-\x7f])"
    rules = rules.select("*", front.alias("front"), end.alias("end"), lowered(F.when(end, F.expr("substr(rule, 1, length(rule) - 1)")).otherwise(F.col("rule"))).alias("body")).withColumn("body", body)
    pattern = F.regexp_replace(F.regexp_replace(F.regexp_replace("body", escaped, r"\\$1"), r"\*", ".*"), r"\^", "(?:[^a-z0-9]|\\$)")
    start = F.when(F.col("front") == "||", r"^[^/?#]*://(?:[^/?#]*\.)?").when(F.col("front") == "|", "^").otherwise("")
    of_pattern = F.concat(F.lit("(?s)"), start, pattern, F.when(F.col("end"), r"\z").otherwise(""))
    of_place = F.concat(F.lit(r"^(?:[^/]*\.)?"), F.regexp_replace("rule", r"([\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f])", r"\\$1"))
    # a token beside an open end or a * may go on there
    open_body = F.concat(F.when(F.col("front") == "", "*").otherwise(""), "body", F.when(F.col("end"), "").otherwise("*"))
    literal = F.when(F.col("place"), F.concat(lowered(F.col("rule")), F.lit("*"))).otherwise(open_body)
    level = F.when(F.col("place"), 2).when(F.col("action") == "allow", 1).otherwise(0)
    number = F.row_number().over(Window.orderBy(level, F.length("rule"), "action", "rule"))
    return rules.select("rule", "action", "place", number.alias("number"), F.when(F.col("place"), of_place).otherwise(of_pattern).alias("regex"), F.regexp_extract_all(literal, F.lit(r"(?<![a-z0-9*])[a-z0-9]+(?![a-z0-9*])"), F.lit(0)).alias("words"))


def rule_index(rules: DataFrame, urls: DataFrame, url_col: str = "url", small: bool = True) -> DataFrame:
    """(token, number, regex, place): compiled rules by the token of theirs that the fewest urls have."""
    hint = F.broadcast if small else (lambda x: x)
    asked = rules.select(F.explode_outer("words").alias("token"), "number").distinct()
    held = urls.select(F.explode(tokens(lowered(F.col(url_col)))).alias("t"))
    held = held.join(hint(asked.select("token").distinct()), F.col("t") == F.col("token"), "left_semi").groupBy("t").agg(F.count("*").alias("n"))
    rarest = asked.join(hint(held), F.col("token") == F.col("t"), "left").groupBy("number").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), -F.length("token"), F.col("token"))).alias("token"))
    return rules.join(hint(rarest), "number").select(F.coalesce("token", F.lit("")).alias("token"), F.col("number").alias("rule_number"), "regex", "place")


def judged(pages: DataFrame, rules: DataFrame | None = None, url_col: str = "url", keep: tuple = ("page_id",)) -> DataFrame:
    """The columns `keep` of every row, and host, path, rule (the place that decides, else null), verdict (allow or block: that
    of the place or pattern that decides, else allow), pattern (that decides, else null).

    A null url, or one without ://, has an empty host and path, which no place fits; patterns are held against the text
    there is. Equal rows get a row each; an empty table gives none; without rules all are allowed. A url's rows are added
    up where they are made, so a token that many urls have weighs no more than others. Only `keep` goes through the
    shuffle, under names of its own, so columns of any name may be kept, but for those that are new here.
    """
    rules = compiled(rule_table(pages.sparkSession) if rules is None else rules)
    small = rules.agg(F.coalesce(F.sum(F.length("rule") * 6 + F.length("regex") * 6 + 64), F.lit(0))).first()[0] <= BROADCAST_BYTES
    hint = F.broadcast if small else (lambda x: x)
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.monotonically_increasing_id().alias("__row"), *(F.col(c).alias(f"__{k}") for k, c in enumerate(keep)), host.alias("__host"), path.alias("__path"), lowered(F.col(url_col)).alias("__url"))
    index = rule_index(rules, pages, url_col, small)
    asking = rows.select("*", F.explode(tokens(F.col("__url"))).alias("__token"))
    if small:
        found = asking.join(F.broadcast(index), F.col("__token") == F.col("token"), "left")
    else:
        asking = asking.withColumn("__salt", F.pmod("__row", F.lit(SALTS)))
        index = index.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        found = asking.join(index, (F.col("__token") == F.col("token")) & (F.col("__salt") == F.col("salt")), "left")
    target = F.when(F.col("place"), F.concat("__host", "__path")).otherwise(F.col("__url"))
    fits = F.when(F.col("regex").isNotNull() & F.regexp_like(target, F.col("regex")), F.col("rule_number"))
    own = [f"__{k}" for k in range(len(keep))]
    best = found.select("__row", *own, "__host", "__path", "__token", fits.alias("__fits")).where("__token = '' or __fits is not null")
    best = best.groupBy("__row", *own, "__host", "__path").agg(F.max("__fits").alias("__best"))
    named = rules.select(F.col("number").alias("__best"), F.col("rule").alias("__rule"), F.col("action").alias("__action"), F.col("place").alias("__place"))
    out = best.join(hint(named), "__best", "left")
    return out.select(
        *(F.col(x).alias(c) for x, c in zip(own, keep, strict=True)),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.when(F.col("__place"), F.col("__rule")).alias("rule"),
        F.coalesce("__action", F.lit("allow")).alias("verdict"),
        F.when(~F.col("__place"), F.col("__rule")).alias("pattern"),
    )


def op13_url_rules(spark, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern of every page."""
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP13_SQL = r"""
with p as (select row_number() over () as rid, page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path from pages),
r(action, h, s) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f as (select rid, arg_max(h || s, length(h || s)) as rule, arg_max(action, length(h || s)) as action from p join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, s) group by rid),
w(word, place) as (values ('adult', 1), ('porn', 2), ('xxx', 3), ('casino', 4), ('poker', 5), ('bets', 6), ('betting', 7), ('pills', 8), ('viagra', 9), ('spam', 10), ('ads', 11), ('adserver', 12), ('tracker', 13), ('cgi-bin', 14)),
t as (select rid, '^' || word || '^' as pattern, 0 as allows from p join w on regexp_matches(url, '[^a-z0-9]' || word || '([^a-z0-9]|$)')
    union all select rid, '^wp-login.php', 0 from p where regexp_matches(url, '[^a-z0-9]wp-login\.php')
    union all select rid, '^robots.txt|', 1 from p where regexp_matches(url, '[^a-z0-9]robots\.txt$')),
b as (select rid, arg_max(pattern, (allows, length(pattern), pattern)) as pattern, max(allows) as allows from t group by rid)
select page_id, host, path, rule, case when rule is not null then action when allows = 0 then 'block' else 'allow' end as verdict, case when rule is null then pattern end as pattern
from p left join f using (rid) left join b using (rid)
"""
