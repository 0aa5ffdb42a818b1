"""Collapse of cumulative conversation snapshots and chat rendering (operator 3), in DataFrame operations only.

Logs often hold the same conversation again after every turn. Each turn gets two 64-bit hashes of its place, role and text;
the exclusive or of a conversation's first k hashes identifies its prefix of k turns. A conversation whose whole identifies
as a proper prefix of another is dropped by an anti-join, and of equal conversations the smallest conv_id stays. Those that
remain are rendered.

Prefix hashes are put together from parts of ``SPAN`` turn numbers, so a conversation of very many turns is not one task's work;
its rendering comes in parts as well (``part``), one per span of turn numbers. Prefixes that many conversations share are made distinct before the join.

Roles are trimmed and lower-cased, with the usual aliases; ``<|`` in texts is written ``< |``, so texts can't form markers.

Defined results: rows with a null conv_id are ignored; a null turn comes first; a null role is ``unknown``, a null text empty;
equal turn numbers are ordered by role and text; repeated rows are turns of their own; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, partitions, table

SPAN = 1024
#: Names that logs use for the three roles.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "instruction": "system"}


def _role(col: str = "role") -> F.Column:
    plain = F.lower(F.trim(F.coalesce(F.col(col), F.lit("unknown"))))
    return F.coalesce(F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])[plain], plain)


def numbered(turns: DataFrame, span: int = SPAN) -> DataFrame:
    """conv_id, part, k (place from 1), role, text and the prefix hashes p1, p2 at every turn."""
    plain = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _role().alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    plain = plain.filter("conv_id is not null").withColumn("part", F.expr(f"coalesce(floor(turn / {span}), {-(2**62)})").cast("long"))
    inside = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    counts = plain.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = plain.withColumn("in_part", F.row_number().over(inside)).join(bases, ["conv_id", "part"])
    placed = placed.select("conv_id", "part", (F.col("base") + F.col("in_part")).alias("k"), "role", "text")
    hashed = placed.withColumn("h1", F.xxhash64("k", "role", "text")).withColumn("h2", F.xxhash64(F.lit("second"), "text", "role", "k"))
    running = Window.partitionBy("conv_id", "part").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    sums = hashed.groupBy("conv_id", "part").agg(F.bit_xor("h1").alias("s1"), F.bit_xor("h2").alias("s2"))
    heads = sums.select("conv_id", "part", *(F.coalesce(F.bit_xor(s).over(before), F.lit(0)).alias(b) for s, b in (("s1", "b1"), ("s2", "b2"))))
    own = hashed.withColumn("r1", F.bit_xor("h1").over(running)).withColumn("r2", F.bit_xor("h2").over(running))
    joined = own.join(heads, ["conv_id", "part"])
    return joined.select("conv_id", "part", "k", "role", "text", F.expr("r1 ^ b1").alias("p1"), F.expr("r2 ^ b2").alias("p2"))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that are no prefix of another; ``turns`` as from :func:`numbered`."""
    ends = turns.groupBy("conv_id").agg(F.max("k").alias("n_turns"), F.max_by(F.struct("p1", "p2"), "k").alias("p"))
    whole = ends.groupBy("n_turns", "p.p1", "p.p2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = turns.join(ends.select("conv_id", "n_turns"), "conv_id").filter("k < n_turns").select(F.col("k").alias("n_turns"), "p1", "p2").distinct()
    return whole.join(inner, ["n_turns", "p1", "p2"], "left_anti").select("conv_id", "n_turns", "n_copies")


def format_chats(turns: DataFrame, span: int = SPAN) -> DataFrame:
    """conv_id, part, first_turn, n_turns, n_copies and the rendered text of every part of the maximal conversations."""
    files = partitions(turns)
    steps = materialise(numbered(turns, span).coalesce(files), "turns")
    kept = maximal(steps).withColumnRenamed("conv_id", "_conv")
    line = F.concat(F.lit("<|"), F.replace("role", F.lit("<|"), F.lit("< |")), F.lit("|>\n"), F.replace("text", F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n"))
    chosen = steps.join(kept, F.col("conv_id") == F.col("_conv"))
    parts = chosen.groupBy("conv_id", "part", "n_turns", "n_copies").agg(F.min("k").alias("first_turn"), F.sort_array(F.collect_list(F.struct("k", line.alias("line")))).alias("lines"))
    return parts.select("conv_id", "part", "first_turn", "n_turns", "n_copies", F.expr("array_join(transform(lines, x -> x.line), '')").alias("text")).coalesce(files)


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


OP3_SQL = r"""
with a(alias, name) as (values ('human','user'),('prompter','user'),('gpt','assistant'),('bot','assistant'),('model','assistant'),('ai','assistant'),('instruction','system')),
t as (select cast(conv_id as bigint) conv_id, cast(turn as bigint) turn, coalesce(a.name, lower(trim(coalesce(role, 'unknown')))) as role, coalesce(text, '') as text
 from conversations left join a on a.alias = lower(trim(coalesce(role, 'unknown'))) where conv_id is not null),
k as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) k, cast(floor(turn / 1024) as bigint) part from t),
p as (select *, md5(string_agg(md5(role) || md5(text), '' ) over (partition by conv_id order by k)) as prefix, count(*) over (partition by conv_id) n_turns from k),
e as (select min(conv_id) conv_id, count(*) n_copies, k, prefix from p where k = n_turns group by k, prefix),
m as (select e.* from e where not exists (select 1 from p where p.k = e.k and p.prefix = e.prefix and p.k < p.n_turns))
select p.conv_id, p.part, min(p.k) as first_turn, p.n_turns, m.n_copies, string_agg('<|' || replace(p.role, '<|', '< |') || '|>' || chr(10) || replace(p.text, '<|', '< |') || '<|end|>' || chr(10), '' order by p.k) as text
from p join m using (conv_id) group by p.conv_id, p.part, p.n_turns, m.n_copies
"""
