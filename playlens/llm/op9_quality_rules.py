"""Quality rules with host verdicts, in DataFrame functions only.

Each text is measured by itself. A document fails if a base rule fails (few
words, or many words in repeated passages) or if its symbols or repeated lines
exceed their share. Failures are summed by host; the hosts' rates give a beta
prior by their mean and variance (moments) and each host's rate is shrunk to it.
The prior counts as ``PRIOR_MOST`` documents at most, however many hosts agree,
so that it speaks for small hosts and not against what a large one shows. A host
loses all documents if the lower bound of its posterior (``SURE`` standard
deviations below the shrunk rate) exceeds ``HOST_LIMIT``.

Edge cases: a null text has no words and fails the base rules; a document
without a host is judged by itself; with no documents, or hosts that are all
alike, the prior has the weight ``PRIOR_MOST`` and every rate is near the mean;
rows that repeat count each. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm import common as C

MIN_WORDS, REPEAT_PERCENT, SPAN = 20, 30, 8
SYMBOL_PERCENT, LINE_PERCENT = 50, 50
HOST_LIMIT = 0.8
#: Weight of the prior, in documents, when the hosts' rates hardly vary; and at the least.
PRIOR_MOST, PRIOR_LEAST = 20.0, 2.0
#: Standard deviations of the posterior that a host must be above the limit by: one tail of 5 %.
SURE = 1.645
#: Failing hosts that are sent to every task.
HOSTS_SENT = 50_000
SPACE, WORD, SYMBOLS = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]", r"[#*$%&|<>]"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def repeated_words(words: Column, span: int = SPAN) -> Column:
    """Words in ``span``-word windows that the text has twice or more.

    Windows are compared by 64-bit hashes. Only a text that has an equal pair
    sorts its windows; the places of equal ones then give the words they cover.
    """
    def covered(hashes):
        def count(pairs):
            last = F.size(pairs)
            twice = F.filter(pairs, lambda x, i: (F.get(pairs, i - 1)["h"] == x["h"]) | (
                (i + 1 < last) & (F.get(pairs, i + 1)["h"] == x["h"])))
            places = F.array_sort(F.transform(twice, lambda x: x["i"]))
            start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-span).alias("at"))
            return F.aggregate(places, start, lambda acc, x: F.struct(
                (acc["n"] + F.least(F.lit(span), x - acc["at"])).alias("n"), x.alias("at")), lambda acc: acc["n"])

        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(pairs, count)).otherwise(F.lit(0).cast("long"))

    def windows(w):
        # element by element: slice() would copy the whole array for every window
        return F.transform(F.sequence(F.lit(0), F.size(w) - span),
                           lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(span))))

    return _let(words, lambda w: F.when(F.size(w) > span, _let(windows(w), covered)).otherwise(F.lit(0).cast("long")))


def measures(text: Column) -> list[Column]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of a text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(WORD))
    of_words = _let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    of_lines = _let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long")
    return [of_words.alias("w"), of_lines.alias("l"), symbols.alias("n_symbols")]


def judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, *more: Column) -> DataFrame:
    """One row per document: id, host, the measures, base_failed and failed (any rule)."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{host_col}`").alias("host"), *measures(text), *more)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    other = (100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("n_words")) | (
        100 * F.col("n_dup_lines") > LINE_PERCENT * F.col("n_lines"))
    return (rows.select("*", "w.*", "l.*").drop("w", "l")
            .withColumn("base_failed", base).withColumn("failed", F.col("base_failed") | other))


def host_verdicts(rows: DataFrame) -> DataFrame:
    """host, n_docs, n_failed, rate (shrunk) and host_ok, from rows with ``host`` and ``failed``."""
    hosts = (rows.where(F.col("host").isNotNull()).groupBy("host")
             .agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")))
    n, bad = F.sum("n_docs"), F.sum("n_failed")
    squares = F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs"))
    total = hosts.agg(F.struct((bad / n).alias("mean"), (squares / n - (bad / n) * (bad / n)).alias("var")).alias("p"))
    mean, var = F.col("p.mean"), F.col("p.var")
    weight = F.when(var > 0, F.least(F.greatest(mean * (1 - mean) / var - 1, F.lit(PRIOR_LEAST)), F.lit(PRIOR_MOST)))
    prior = total.select(F.struct(mean.alias("mean"), F.coalesce(weight, F.lit(PRIOR_MOST)).alias("weight"))).scalar()
    counted, rate = F.col("n_docs") + F.col("prior.weight"), F.col("rate")
    return (hosts.withColumn("prior", prior)
            .withColumn("rate", (F.col("n_failed") + F.col("prior.mean") * F.col("prior.weight")) / counted)
            .withColumn("host_ok", rate - SURE * F.sqrt(rate * (1 - rate) / (counted + 1)) <= HOST_LIMIT).drop("prior"))


def _with_verdicts(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    ok = F.coalesce(F.col("host_ok"), F.lit(True))
    return (rows.join(hosts.select("host", "rate", "host_ok"), "host", "left")
            .withColumn("kept", ~F.col("base_failed") & ok))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The measures and verdict of every document; texts are measured once, and hosts from the measures."""
    rows = C.cut(judged(docs, id_col, text_col, host_col))
    return _with_verdicts(rows, host_verdicts(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.col("rate").alias("host_rate"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents kept, with all their columns.

    Each text is measured once; the rows go to the shared folder with their
    verdicts, and no text is shuffled while the failing hosts stay below
    ``HOSTS_SENT`` (each is at most a host name; beyond that they are joined).
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = C.cut(judged(docs, id_col, text_col, host_col, row).select("host", "base_failed", "failed", "row"))
    bad = C.cut(host_verdicts(rows.select("host", "failed")).where(~F.col("host_ok")).select("host"))
    few = bad.agg(F.count("*") <= HOSTS_SENT, F.coalesce(F.sum(F.octet_length("host")), F.lit(0)) <= HOSTS_SENT * 100).first()
    return (rows.where(~F.col("base_failed")).join(F.broadcast(bad) if all(few) else bad, "host", "left_anti").select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    return quality_rules(C.read_documents(spark, sf_dir)).drop("host_rate")


SQL = rf"""
with d as (
  select doc_id, source, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda w: w <> '') as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) as ls
  from documents),
win as (
  select doc_id, p, list_slice(ws, p + 1, p + {SPAN}) as g
  from (select doc_id, ws, unnest(range(0, greatest(len(ws) - {SPAN} + 1, 0))) as p from d)),
twice as (select doc_id, p from (select doc_id, p, count(*) over (partition by doc_id, g) as c from win) where c > 1),
cov as (
  select doc_id, sum(step) as n from (
    select doc_id, least({SPAN}, p - coalesce(lag(p) over (partition by doc_id order by p), p - {SPAN})) as step from twice)
  group by doc_id),
m as (
  select d.doc_id, source as host, cast(len(ws) as bigint) as n_words,
         cast(length(array_to_string(ws, '')) as bigint) as word_chars,
         cast(length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) as bigint) as n_symbols,
         cast(len(ls) as bigint) as n_lines, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
         cast(coalesce(cov.n, 0) as bigint) as n_repeat_words
  from d left join cov on d.doc_id = cov.doc_id),
b as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words as base_failed from m),
f as (
  select *, base_failed or 100 * n_symbols > {SYMBOL_PERCENT} * n_words
            or 100 * n_dup_lines > {LINE_PERCENT} * n_lines as failed from b),
h as (
  select host, cast(count(*) as double) as n_docs, cast(count(*) filter (where failed) as double) as n_failed
  from f where host is not null group by host),
p0 as (
  select sum(n_failed) / sum(n_docs) as mean,
         sum(n_failed * n_failed / n_docs) / sum(n_docs) - (sum(n_failed) / sum(n_docs)) ** 2 as var from h),
p as (
  select mean, case when var > 0 then least(greatest(mean * (1 - mean) / var - 1, 2.0), 20.0) else 20.0 end as weight from p0),
v as (
  select host, rate - 1.645 * sqrt(rate * (1 - rate) / (counted + 1)) <= 0.8 as ok from (
    select host, n_docs + weight as counted, (n_failed + mean * weight) / (n_docs + weight) as rate from h, p))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(ok, true) as kept
from f left join v on f.host = v.host
"""
