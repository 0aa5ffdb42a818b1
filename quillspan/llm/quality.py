"""Quality rules as a short-circuit cascade (operator 4), in DataFrame operations only.

Each rule is a Boolean column that is true where a text fails. On a bounded sample (``SAMPLE_ROWS`` documents) the
cascade measures what each rule costs and how much it rejects, and orders the rules by rejection per cost; a text meets
the next rule only if it passed those before. The order decides the time, never the verdict: a text is kept if it
fails no rule.

Words are runs of characters other than ASCII white space. Windows of eight words are compared by 64-bit hashes of
their words' 64-bit hashes.

Defined results: a null or blank text has no words and fails the rule on few words; repeated rows give repeated rows;
no rows give no rows; ``filter_documents`` keeps extra columns as they are.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import local_rows, table

WINDOW = 8
#: The sample decides the order of the rules alone; it is bounded in rows and characters.
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_COPIES, RUNS = 256, 65_536, 6, 3


@dataclass(frozen=True)
class Limits:
    """Thresholds of the rules. A text fails where a measure is beyond them."""

    min_words: int = 20
    max_repeat_percent: int = 30
    max_symbol_percent: int = 5  # symbols against characters in words
    max_dup_line_percent: int = 50  # lines that repeat an earlier line against lines with a word
    max_mean_word: int = 40  # characters a word
    max_stutter_percent: int = 30  # words equal to the word before them


def words(text: str = "text") -> str:
    trimmed = f"trim(BOTH ' \\t\\n\\u000b\\u000c\\r' FROM coalesce({text}, ''))"
    return f"if({trimmed} = '', array(), split({trimmed}, '[\\\\x20\\\\x09-\\\\x0D]+'))"


def n_symbols(text: str = "text") -> str:
    return f"cast(char_length(coalesce({text}, '')) - char_length(regexp_replace(coalesce({text}, ''), '[#*$%&|<>]', '')) as bigint)"


def lines(text: str = "text") -> str:
    """The \\n-split lines that hold a word."""
    return f"filter(split(coalesce({text}, ''), '\\n'), l -> trim(BOTH ' \\t\\n\\u000b\\u000c\\r' FROM l) <> '')"


def stutter(words: str) -> str:
    """How many words equal the word before them."""
    return f"size(filter({words}, (v, i) -> i > 0 and v = get({words}, i - 1)))"


#: Hash of every window of WINDOW words, from the array ``words``.
WORD_HASHES = "transform(words, w -> xxhash64(w))"
WINDOW_HASHES = f"if(size(words) < {WINDOW}, cast(array() as array<bigint>), transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64({', '.join(f'get(word_hashes, i + {k})' for k in range(WINDOW))})))"
#: Words inside windows that occur twice or more; sorting brings equal windows together, then their places are merged.
SORTED = "sort_array(transform(windows, (h, i) -> struct(h, i)))"
PLACES = "sort_array(transform(filter(transform(sorted_windows, (x, k) -> if(x.h = get(sorted_windows, k - 1).h or x.h = get(sorted_windows, k + 1).h, x.i, null)), i -> i is not null), i -> i))"
COVERED = f"aggregate(places, struct(-{WINDOW} as last, 0L as n), (a, p) -> struct(p as last, a.n + least({WINDOW}, p - a.last) as n), a -> a.n)"


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add n_repeat_words from ``words``; sorts windows only where some repeat."""
    df = df.withColumn("word_hashes", F.expr(WORD_HASHES)).withColumn("windows", F.expr(WINDOW_HASHES))
    df = df.withColumn("sorted_windows", F.expr(f"if(size(array_distinct(windows)) = size(windows), null, {SORTED})"))
    df = df.withColumn("places", F.expr(f"if(sorted_windows is null, null, {PLACES})"))
    df = df.withColumn("n_repeat_words", F.expr(f"if(places is null, 0L, {COVERED})"))
    return df.drop("word_hashes", "windows", "sorted_windows", "places")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, text, words and all measures of every row that the report needs; ``rules`` have the rest."""
    df = docs.select("doc_id", "text").withColumn("words", F.expr(words()))
    df = df.withColumn("n_words", F.expr("cast(size(words) as bigint)"))
    df = df.withColumn("word_chars", F.expr("cast(char_length(array_join(words, '')) as bigint)"))
    df = _repeat_words(df)
    df = df.withColumn("n_symbols", F.expr(n_symbols()))
    df = df.withColumn("lines", F.expr(lines()))
    df = df.withColumn("n_lines", F.expr("cast(size(lines) as bigint)"))
    return df.withColumn("n_dup_lines", F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)")).drop("lines")


def rules(limits: Limits) -> dict[str, str]:
    """Failure conditions over the measures; what no other rule measures is measured in the rule, where the cascade reaches it."""
    return {
        "few_words": f"n_words < {limits.min_words}",
        "repeated_windows": f"100 * n_repeat_words > {limits.max_repeat_percent} * n_words",
        "symbols": f"100 * n_symbols > {limits.max_symbol_percent} * word_chars",
        "repeated_lines": f"n_lines >= 4 and 100 * n_dup_lines > {limits.max_dup_line_percent} * n_lines",
        "long_words": f"word_chars > {limits.max_mean_word} * n_words",
        "stutter": f"100 * {stutter('words')} > {limits.max_stutter_percent} * n_words",
    }


def lazy_rules(limits: Limits) -> dict[str, str]:
    """The same rules straight from the text, each paying only for its own measures."""
    w = words()
    hashes = f"transform({w}, w -> xxhash64(w))"
    window = f"transform(sequence(0, size(x) - {WINDOW}), i -> xxhash64({', '.join(f'get(x, i + {k})' for k in range(WINDOW))}))"
    by = lambda value, name, then: f"get(transform(array({value}), {name} -> {then}), 0)"  # noqa: E731  let name = value in then
    places = "sort_array(filter(transform(s, (x, k) -> if(x.h = get(s, k - 1).h or x.h = get(s, k + 1).h, x.i, null)), i -> i is not null))"
    covered = f"aggregate({places}, struct(-{WINDOW} as last, 0L as n), (a, p) -> struct(p as last, a.n + least({WINDOW}, p - a.last) as n), a -> a.n)"
    repeated = by(hashes, "x", f"if(size(x) < {WINDOW}, false, " + by(window, "h", "if(size(array_distinct(h)) = size(h), false, " + by("sort_array(transform(h, (h, i) -> struct(h, i)))", "s", f"100 * {covered} > {limits.max_repeat_percent} * size(x)") + ")") + ")")
    chars = "char_length(regexp_replace(coalesce(text, ''), '[\\\\x20\\\\x09-\\\\x0D]+', ''))"
    return {
        "few_words": f"size({w}) < {limits.min_words}",
        "repeated_windows": repeated,
        "symbols": f"100 * {n_symbols()} > {limits.max_symbol_percent} * {chars}",
        "repeated_lines": by(lines(), "l", f"size(l) >= 4 and 100 * (size(l) - size(array_distinct(l))) > {limits.max_dup_line_percent} * size(l)"),
        "long_words": by(w, "x", f"char_length(array_join(x, '')) > {limits.max_mean_word} * size(x)"),
        "stutter": by(w, "x", f"100 * {stutter('x')} > {limits.max_stutter_percent} * size(x)"),
    }


def cascade_order(docs: DataFrame, conditions: dict[str, str], rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejection per cost, measured on at most ``rows`` documents; rules that reject nothing come last, cheapest first.

    A rule's cost is the least time of ``RUNS`` runs after one that warms up, less that of a rule that does nothing.
    """
    taken = docs.select(F.substring("text", 1, SAMPLE_CHARS).alias("text")).take(rows)  # reads the first partitions only
    n = max(1, len(taken))
    sample = local_rows(docs.sparkSession, [(r.text,) for r in taken], {"text": "string"})
    again = sample.select("text", F.explode(F.sequence(F.lit(1), F.lit(SAMPLE_COPIES))).alias("copy")).select(F.concat("text", F.lit("\n"), F.col("copy").cast("string")).alias("text"))

    def run(condition: str) -> tuple[int, float]:
        times = []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            failed = again.agg(F.sum(F.expr(f"cast({condition} as int)")).alias("n")).first().n or 0
            times.append(time.perf_counter() - began)
        return failed, min(times[1:])

    nothing = run("text = ''")[1]
    found = {}
    for name, condition in conditions.items():
        failed, took = run(condition)
        found[name] = (failed / n / SAMPLE_COPIES, max(took - nothing, 1e-4))
    return sorted(found, key=lambda k: (-found[k][0] / found[k][1], found[k][1]))


def verdict(order: list[str], conditions: dict[str, str]) -> Column:
    """True where no rule fails; nested conditions, so a rule is evaluated only where all before it passed."""
    sql = "true"
    for name in reversed(order):
        sql = f"case when coalesce({conditions[name]}, false) then false else {sql} end"
    return F.expr(sql)


def filter_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that fail no rule, all columns kept."""
    conditions = lazy_rules(limits)
    return docs.filter(verdict(cascade_order(docs, conditions), conditions))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = Limits()
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    conditions = rules(limits)
    measured = measure(docs)
    order = cascade_order(docs, lazy_rules(limits))
    base = F.expr(f"({conditions['few_words']}) or ({conditions['repeated_windows']})")
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), verdict(order, conditions).alias("kept"))


OP4_SQL = r"""
with d as (select cast(doc_id as bigint) doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
g as (select doc_id, i, list_aggregate(ws[i:i+7], 'string_agg', ' ') as win from w, unnest(range(1, greatest(len(ws) - 6, 1))) as r(i)),
c as (select doc_id, i, count(*) over (partition by doc_id, win) as n from g),
p as (select doc_id, i, least(8, i - coalesce(lag(i) over (partition by doc_id order by i), -8)) as fresh from c where n > 1),
r as (select doc_id, sum(fresh) as n_repeat_words from p group by doc_id),
m as (select w.doc_id, cast(len(ws) as bigint) n_words, cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as bigint) word_chars,
 cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) n_symbols, cast(len(ls) - len(list_distinct(ls)) as bigint) n_dup_lines, len(ls) n_lines,
 cast(coalesce(n_repeat_words, 0) as bigint) n_repeat_words, len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) n_stutter from w left join r using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
 n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
 not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or 100 * n_symbols > 5 * word_chars or (n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines) or word_chars > 40 * n_words or 100 * n_stutter > 30 * n_words) as kept
from m
"""
