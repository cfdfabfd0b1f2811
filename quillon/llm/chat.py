r"""Chat formatting in budgeted windows, by DataFrame functions alone.

A turn is written as ``### role: text</turn>`` and a line feed. Inside roles and texts a backslash becomes two, ``</`` becomes ``<\/`` and ``##`` becomes ``#\#``, so that neither control string can occur in them; in roles ``:`` becomes ``\:`` too. One pass that drops a backslash and keeps what follows it restores the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "</turn>\n"
HEAD = "### "
BUDGET, HISTORY = 1024, 256
OVERHEAD = 8  # tokens of a turn's marks


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(c, F.lit("</"), F.lit("<\\/")), F.lit("##"), F.lit("#\\#"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def turn_tokens(text: Column) -> Column:
    """The default measure: a token for each word, digit group or sign, and a turn's marks."""
    return F.regexp_count(text, F.lit(r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]")).cast("long") + OVERHEAD


def format_chats(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, measure=turn_tokens, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, window, formatted, n_turns, n_repeated, tokens, loss): windows of whole turns.

    Prefix sums P of turn tokens place each turn: with a room of budget - history - system tokens, a turn that lies in one stretch [k * room, (k + 1) * room) joins the window of that stretch, a turn across two stretches has a window of its own; so new turns fit the room, save a single turn longer than it, which stays whole. A conversation's leading system turn opens each later window too; then come the last turns before the window whose tokens sum to ``history`` at most. These ``n_repeated`` turns carry no loss.
    ``loss`` lists (start, length), 1-based code points of ``formatted``: the escaped text of each new assistant turn.

    Null texts and roles count as empty. Order in a conversation: turn (null first), role, text; repeated rows are turns of their own. Null conv_ids are one conversation. A conversation's turns meet in one task, which streams them; only a window's turns and history meet in a row."""
    seg = F.concat(F.lit(HEAD), F.replace(escape(F.col("r")), F.lit(":"), F.lit("\\:")), F.lit(": "))
    rows = turns.select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit("")).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("x"))
    rows = rows.withColumns({"n": measure(F.col("x")), "h": seg, "e": escape(F.col("x"))})
    order = Window.partitionBy("c").orderBy("t", "r", "x")
    rows = rows.withColumns({"i": F.row_number().over(order), "p": F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))})
    one = F.struct("i", "h", "e", "n", (F.col("r") == "assistant").alias("a"))
    rows = rows.withColumns({"p": F.coalesce("p", F.lit(0)), "one": one, "lead": (F.col("i") == 1) & (F.col("r") == "system")})
    rows = rows.withColumn("sys", F.first(F.when(F.col("lead"), F.col("one"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    room = F.greatest(F.lit(budget - history) - F.coalesce("sys.n", F.lit(0)), F.lit(1))
    begin, end = F.floor(F.col("p") / room), F.floor((F.col("p") + F.col("n") - 1) / room)
    before = F.collect_list(F.when(~F.col("lead"), F.col("one"))).over(Window.partitionBy("c").orderBy("p").rangeBetween(-history, -1))
    rows = rows.withColumns({"span": 2 * begin + (begin != end).cast("long"), "before": before})
    found = rows.groupBy("c", "span").agg(F.array_sort(F.collect_list("one")).alias("new"), F.min(F.struct("i", "before")).alias("first"), F.first("sys").alias("sys"))
    leading = F.when(F.col("sys").isNotNull() & (F.col("first.i") > 1), F.array("sys")).otherwise(F.expr("array()").cast("array<struct<i:int,h:string,e:string,n:bigint,a:boolean>>"))
    found = found.withColumn("old", F.concat(leading, "first.before"))
    write = lambda arr: F.array_join(F.transform(arr, lambda o: F.concat(o.h, o.e, F.lit(END))), "")
    found = found.withColumns({"prefix": write("old"), "body": F.transform("new", lambda o: F.concat(o.h, o.e, F.lit(END)))})
    sizes = F.transform("body", F.length)
    starts = F.aggregate(sizes, F.struct(F.length("prefix").alias("at"), F.expr("cast(array() as array<int>)").alias("s")), lambda acc, n: F.struct((acc.at + n).alias("at"), F.concat(acc.s, F.array(acc.at)).alias("s")), lambda acc: acc.s)
    loss = F.filter(F.zip_with("new", starts, lambda o, s: F.struct((s + F.length(o.h) + 1).alias("start"), F.length(o.e).alias("len"), o.a.alias("a"))), lambda z: z.a)
    tokens = F.aggregate(F.concat("old", "new"), F.lit(0).cast("long"), lambda s, o: s + o.n)
    return found.select(
        F.col("c").alias("conv_id"), F.col("span").alias("window"), F.concat("prefix", F.array_join("body", "")).alias("formatted"),
        F.size("new").alias("n_turns"), F.size("old").alias("n_repeated"), tokens.alias("tokens"), F.transform(loss, lambda z: F.struct(z.start.alias("start"), z.len.alias("len"))).alias("loss"),
    )


def read_turns(formatted: Column, skip: Column) -> Column:
    """array of (role, text) read back from a formatted window, without its first ``skip`` turns."""
    parts = F.split(formatted, END, -1)
    parts = F.slice(parts, skip + 1, F.greatest(F.size(parts) - 1 - skip, F.lit(0)))
    head = r"(?s)^### ((?:[^\\:]|\\.)*+): "
    return F.transform(parts, lambda s: F.struct(unescape(F.regexp_extract(s, head, 1)).alias("role"), unescape(F.regexp_replace(s, head + "(.*)$", "$2")).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda z: unescape(F.substring(formatted, z.start, z.len))), "")


def digest(windows: DataFrame) -> DataFrame:
    """Per conversation, what its windows hold when they are read back."""
    new = read_turns(F.col("formatted"), F.col("n_repeated"))
    text = F.array_join(F.transform(new, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    rows = windows.select("conv_id", F.struct("window", F.size(new).cast("long").alias("n"), text.alias("t"), read_loss(F.col("formatted"), F.col("loss")).alias("l")).alias("w"), F.length("formatted").cast("long").alias("f"))
    by = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"), F.sum("f").alias("formatted_chars"), F.count("*").alias("n_windows"))
    lost = F.array_join("w.l", "")
    return by.select(
        "conv_id", F.aggregate("w.n", F.lit(0).cast("long"), lambda a, b: a + b).alias("n_turns"), F.sha2(F.array_join("w.t", ""), 256).alias("turns_sha256"),
        F.length(lost).cast("long").alias("loss_chars"), F.sha2(lost, 256).alias("loss_sha256"), "formatted_chars", "n_windows",
    )


def query(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return digest(format_chats(turns.unionByName(extra)))


SQL = rf"""
with base as (select conv_id c, turn t, coalesce(role, '') r, coalesce(text, '') x from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (select *, replace(replace(replace(replace(r, '\', '\\'), '</', '<\/'), '##', '#\#'), ':', '\:') er, replace(replace(replace(x, '\', '\\'), '</', '<\/'), '##', '#\#') ex,
  len(regexp_extract_all(x, '\p{{L}}+|\p{{N}}{{1,3}}|[^\s\p{{L}}\p{{N}}]')) + {OVERHEAD} n from base),
o as (select *, length('### ' || er || ': ' || ex || '</turn>') + 1 size, row_number() over w i, coalesce(sum(n) over (w rows between unbounded preceding and 1 preceding), 0) p from e window w as (partition by c order by t nulls first, r, x)),
s as (select c, n, size from o where i = 1 and r = 'system'),
q as (select o.*, greatest({BUDGET} - {HISTORY} - coalesce(s.n, 0), 1) room, coalesce(s.size, 0) lead_size, o.i = 1 and o.r = 'system' lead from o left join s using (c)),
b as (select *, 2 * (p // room) + cast(p // room <> (p + n - 1) // room as int) span from q),
f as (select c, span, min(i) i, min(p) p, min(lead_size) lead_size from b group by c, span),
h as (select f.c, f.span, sum(b.size) old from f join b on b.c = f.c and not b.lead and b.p between f.p - {HISTORY} and f.p - 1 group by f.c, f.span),
w as (select f.c, count(*) n_windows, sum(coalesce(h.old, 0) + case when f.i > 1 then f.lead_size else 0 end) extra from f left join h on h.c = f.c and h.span = f.span group by f.c),
t as (select c, count(*) n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' order by i)) turns_sha256, coalesce(string_agg(x, '' order by i) filter (where r = 'assistant'), '') lost, sum(size) size from b group by c)
select t.c conv_id, n_turns, turns_sha256, cast(length(lost) as bigint) loss_chars, sha256(lost) loss_sha256, cast(size + extra as bigint) formatted_chars, n_windows from t join w using (c)
"""
