"""URL filter: listed rules first, association rules mined from labelled URLs for the rest.

1. A listed rule fits its host and all subdomains if the path starts with the
   rule's; the longest wins. Candidates are the host's own suffixes, so a URL is
   looked up in a literal map of the rules and never compared with all of them.
2. The labels are the verdicts of the listed rules on the URLs that they fit:
   each such URL is a transaction of its tokens and its verdict. FP-growth mines
   the frequent combinations; rules ``tokens -> verdict`` are kept above a support
   and a confidence, and only if no rule of fewer of their tokens is as sure.
3. The kept rules make an inverted index: each is listed under its rarest token.
   A URL without a listed rule looks its tokens up, the candidates whose tokens it
   has all fire, and the surest decides (then the most supported, then the
   shortest; block before allow at a full tie). Without any it is allowed.
   Equal token sets are judged once.

A token is a part of the host, path or query name, with its place; digits do not
count. The index join names no broadcast: the optimizer takes its measured size.
Rules are few in any case: a combination needs ``MIN_SUPPORT`` of all labelled
URLs, and at most ``LONGEST`` tokens. A labelled URL lends all its tokens, and
every URL is matched by all of its own. Where some URL has more than ``WIDTH``
frequent tokens, whose combinations FP-growth would all make, the same rules are
mined by size instead, each size from the one before.

Edge cases: a null URL, or one without ``://``, has an empty host and path, fits
no rule and has no tokens: allowed. Ports and user names stay part of the host,
as the contract has it. Very long URLs keep all their tokens. Repeated rows are
judged each; a null id passes through; with no labelled URL nothing is mined and
the rest is allowed; an empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm import common as C

#: (verdict, rule) of the contract: fixed values.
LISTED = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MIN_SUPPORT, MIN_CONFIDENCE, LONGEST = 0.01, 0.9, 4
#: FP-growth makes up to 2 ** WIDTH combinations of the frequent tokens that one URL has; if any URL has
#: more, the same rules are mined by size.
WIDTH = 12
#: Marks the verdict among the items of a transaction; no token begins with it.
LABEL = "verdict="


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?`` or ``#``, with A-Z lower-cased; empty without one."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules=LISTED) -> Column:
    """(rule, verdict) of the longest listed rule that fits, or null."""
    kind = "array<struct<start:string,rule:string,verdict:string>>"
    if not rules:
        return F.get(F.array().cast(kind), F.lit(0))
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule in rules:
        at, _, start = rule.partition("/")
        by_host.setdefault(at, []).append(("/" + start, rule, verdict))
    table = F.create_map(*(x for at, found in by_host.items() for x in (
        F.lit(at), F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(("start", "rule", "verdict"), r, strict=True)))
                             for r in found)).cast(kind))))
    names = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, i, F.size(names)), "."))
    near = F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(table, s)), lambda x: x.isNotNull()))
    fit = F.filter(near, lambda r: path.startswith(r["start"]))
    # the host's suffixes differ in length, and so do rules of one host: no ties
    return F.get(F.array_sort(fit, lambda a, b: F.length(b["rule"]) - F.length(a["rule"])), F.lit(0))


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL with their place (h: host, p: path, q: names of query values); digits do not count."""
    def parts(text, pattern, place):
        return F.transform(F.filter(F.split(text, pattern), lambda x: ~x.rlike(r"^\d*$")), lambda x: F.concat(F.lit(place), x))

    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    names = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.array_sort(F.array_distinct(F.concat(
        parts(host_of(url), r"[.\-:@_]+", "h:"), parts(F.lower(path_of(url)), r"[^\p{L}\p{N}]+", "p:"),
        F.transform(F.filter(names, lambda x: x != ""), lambda x: F.concat(F.lit("q:"), x)))))


def _by_fpgrowth(rows: DataFrame, min_support: float, min_confidence: float, longest: int) -> DataFrame:
    """(antecedent, verdict, confidence, support) by FP-growth over whole transactions."""
    items = rows.select(F.concat("tokens", F.array(F.concat(F.lit(LABEL), F.col("verdict")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    label = F.col("consequent")[0]
    found = (model.associationRules.where(label.startswith(LABEL) & (F.size("antecedent") <= longest))
             .select(F.array_sort("antecedent").alias("antecedent"),
                     F.substring(label, len(LABEL) + 1, 100).alias("verdict"), "confidence", "support"))
    return found.where(~F.exists("antecedent", lambda x: x.startswith(LABEL)))


def _by_size(often: DataFrame, count: int, least: int, min_confidence: float, longest: int) -> DataFrame:
    """The same rules, mined by size: a combination grows by a later token of its URL, while it is frequent
    with a verdict and has more than one (with one alone it is as sure as any of its extensions).

    Steps grow with ``longest`` and not with the number of tokens, so any width ends."""
    sets = often.select("n", "verdict", F.array("token").alias("a"))
    out = None
    for size in range(1, longest + 1):
        sets = C.cut(sets)
        each = sets.groupBy("a", "verdict").agg(F.count("*").alias("f"))
        of = C.cut(each.groupBy("a").agg(F.sum("f").alias("all"), F.collect_list(F.struct("verdict", "f")).alias("of"))
                   .where(F.exists("of", lambda x: x["f"] >= least)))
        rules = (of.select("a", "all", F.inline("of")).where((F.col("f") >= least) & (F.col("f") / F.col("all") >= min_confidence))
                 .select(F.col("a").alias("antecedent"), "verdict", (F.col("f") / F.col("all")).alias("confidence"),
                         (F.col("f") / F.lit(count)).alias("support")))
        out = rules if out is None else out.union(rules)
        open_ = of.where(F.size("of") > 1).select("a")
        if size < longest:
            sets = (sets.join(open_, "a").join(often.select("n", "token"), "n").where(F.col("token") > F.element_at("a", -1))
                    .select("n", "verdict", F.concat("a", F.array("token")).alias("a")))
    return out


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               longest: int = LONGEST) -> DataFrame:
    """(antecedent, verdict, confidence, support, token) from rows with ``tokens`` and ``verdict``; token is the rarest.

    Every labelled row takes part, with all its tokens.
    """
    rows = C.cut(labelled.select(F.monotonically_increasing_id().alias("n"), "tokens", "verdict"))
    count = rows.count()
    least = math.ceil(min_support * count)
    tokens = rows.select("n", "verdict", F.explode("tokens").alias("token"))
    single = C.cut(tokens.groupBy("token").agg(F.count("*").alias("freq")).where(F.col("freq") >= least))
    often = tokens.join(single.select("token"), "token")
    width = often.groupBy("n").count().agg(F.max("count")).first()[0] or 0
    if width <= WIDTH:
        found = C.cut(_by_fpgrowth(rows, min_support, min_confidence, longest))
    else:
        found = C.cut(_by_size(often, count, least, min_confidence, longest))
    # a rule goes if one of fewer of its tokens has its verdict and is as sure: each rule names its sub-combinations
    n = F.size("antecedent")
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), n).cast("int") - 2)
    subset = F.transform(masks, lambda m: F.filter("antecedent", lambda _, i: F.getbit(m, i) == 1))
    parts = found.where(n > 1).select("antecedent", "verdict", "confidence", F.explode(subset).alias("part"))
    less = found.select(F.col("antecedent").alias("part"), "verdict", F.col("confidence").alias("sure"))
    worse = (parts.join(less, ["part", "verdict"]).where("sure >= confidence").select("antecedent", "verdict").distinct())
    kept = found.join(worse, ["antecedent", "verdict"], "left_anti")
    rarest = (kept.select("antecedent", "verdict", F.explode("antecedent").alias("token")).join(single, "token")
              .groupBy("antecedent", "verdict").agg(F.min(F.struct("freq", "token"))["token"].alias("token")))
    return C.cut(kept.join(rarest, ["antecedent", "verdict"]))


def matched(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined): the verdict of the surest rule that fires on each distinct token set that has one."""
    index = rules.select("token", "antecedent", "verdict", "confidence", "support")
    fired = (token_sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
             .where(F.size(F.array_except("antecedent", "tokens")) == 0))
    order = F.struct("confidence", "support", -F.size("antecedent"), "verdict")      # block is above allow
    return fired.groupBy("tokens").agg(F.max_by("verdict", order).alias("mined"))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", listed=LISTED,
                min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row."""
    url = F.col(f"`{url_col}`")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("listed", listed_rule(F.col("host"), F.col("path"), listed))
    known = rows.where(F.col("listed").isNotNull())
    rest = rows.where(F.col("listed").isNull()).withColumn("tokens", url_tokens(F.col("url")))
    labelled = C.cut(known.select(url_tokens(F.col("url")).alias("tokens"), F.col("listed.verdict").alias("verdict")))
    out = known.select("page_id", "host", "path", "listed.rule", "listed.verdict")
    if labelled.isEmpty():
        mined = rest.withColumn("mined", F.lit(None).cast("string"))
    else:
        rules = mine_rules(labelled, min_support, min_confidence)
        mined = rest.join(matched(rest.select("tokens").distinct(), rules), "tokens", "left")
    return out.union(mined.select("page_id", "host", "path", F.lit(None).cast("string"), F.coalesce("mined", F.lit("allow"))))


def query(spark, sf_dir: str) -> DataFrame:
    return filter_urls(C.read_documents(spark, sf_dir, "pages"))


#: The listed rules and the limits are written out: the SQL shares no constant with the code above.
SQL = r"""
with p0 as (
  select page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
         coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '') as query
  from pages),
p as (select row_number() over () as n, * from p0),
r(v, rule, dom, pre) as (values ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
  ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
fit as (
  select n, arg_max(rule, length(rule)) as rule, arg_max(v, length(rule)) as v
  from p, r where (host = dom or ends_with(host, '.' || dom)) and starts_with(path, pre) group by n),
t as (
  select p.*, fit.rule, fit.v, list_sort(list_distinct(list_concat(list_concat(
    list_transform(list_filter(regexp_split_to_array(host, '[.\-:@_]+'), lambda x: not regexp_full_match(x, '[0-9]*')), lambda x: 'h:' || x),
    list_transform(list_filter(regexp_split_to_array(lower(path), '[^\p{L}\p{N}]+'), lambda x: not regexp_full_match(x, '[0-9]*')), lambda x: 'p:' || x)),
    list_transform(list_filter(list_transform(string_split(query, '&'), lambda x: split_part(x, '=', 1)), lambda x: x <> ''), lambda x: 'q:' || x)
  ))) as tokens
  from p left join fit on p.n = fit.n),
lab as (select n, v, list_slice(tokens, 1, 10) as ts from t where rule is not null),
e as (select n, v, unnest(ts) as x from lab),
e2 as (select a.n, a.v, a.x as x1, b.x as x2 from e a join e b on a.n = b.n and a.x < b.x),
e3 as (select a.*, b.x as x3 from e2 a join e b on a.n = b.n and a.x2 < b.x),
e4 as (select a.*, b.x as x4 from e3 a join e b on a.n = b.n and a.x3 < b.x),
sets as (
  select [x] as a, v from e union all select [x1, x2], v from e2
  union all select [x1, x2, x3], v from e3 union all select [x1, x2, x3, x4], v from e4),
freq as (select a, count(*) as n, v_.v, count(*) filter (where sets.v = v_.v) as f
         from sets, (values ('allow'), ('block')) v_(v) group by a, v_.v),
found as (select a, v, f, f / cast(n as double) as sure from freq
          where f >= ceil(0.01 * (select count(*) from lab)) and f / cast(n as double) >= 0.9),
kept as (select * from found y where not exists (
  select 1 from found z where z.v = y.v and len(z.a) < len(y.a) and list_has_all(y.a, z.a) and z.sure >= y.sure)),
mined as (
  select n, max({'sure': sure, 'f': f, 'short': -len(a), 'v': kept.v})['v'] as v
  from t, kept where t.rule is null and list_has_all(tokens, a) group by n)
select page_id, host, path, rule, coalesce(t.v, mined.v, 'allow') as verdict from t left join mined on t.n = mined.n
"""
