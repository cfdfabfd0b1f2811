"""Tables of reads, chip maps, genes and alignments derived from the driver's tables, as one SQL text for Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TEXTS = {
    "chip_map": """select pk, barcode, cast(pk % 128 as int) x, cast(floor(pk / 128.0) as int) y from (
  select p_partkey pk, (p_partkey * 98245165300007 + 57885161) % 1125899906842624 barcode from part
  union all
  select p_partkey + 1000000 pk, bxor((p_partkey * 98245165300007 + 57885161) % 1125899906842624, shl(2, 2 * (p_partkey % 25))) barcode
  from part where p_partkey % 10 = 0) t""",
    "reads": """select k1, k2, k3, k4, k5, m,
  case when m <= 5 or m = 9 then bc
       when m <= 7 then bxor(bc, shl(1 + k2 % 3, 2 * (k1 % 25)))
       else bxor(bc, shl(1 + k2 % 3, 2 * (k1 % 25)) + shl(1 + k2 % 2, 2 * ((k1 + 7) % 25))) end barcode,
  case when m = 9 then cast(k1 % 25 as int) else -1 end n_pos,
  case when q = 1 then 0 else (k4 * 7919 + k2 * 104729) % 1048576 end umi,
  cast(q as int) base_q
from (select l_orderkey k1, l_linenumber k2, l_partkey k3, l_suppkey k4, l_extendedprice k5, l_quantity q,
        cast((l_orderkey + l_linenumber) % 10 as int) m,
        (l_partkey * 98245165300007 + 57885161) % 1125899906842624 bc from lineitem) t""",
    "genes": """select p_partkey gene_id, cast(floor(p_partkey / 500.0) as int) % 5 chr, p_partkey * 1000 gs, p_partkey * 1000 + p_size * 40 ge,
  cast(p_partkey % 3 as int) strand from part""",
    "blocks": """select k1, k2, k3, k4, k5, cast(floor(k3 / 500.0) as int) % 5 chr, b, k3 * 1000 + k2 * 150 + b * (120 + (k4 % 20) * 60) bs,
  k3 * 1000 + k2 * 150 + b * (120 + (k4 % 20) * 60) + q bend, cast(k1 % 2 as int) str, nh
from (select l_orderkey k1, l_linenumber k2, l_partkey k3, l_suppkey k4, l_extendedprice k5, cast(l_quantity as bigint) q,
        case when l_returnflag = 'R' then cast(2 + l_linenumber % 3 as int) else 1 end nh from lineitem) t
cross join (select 0 b union all select 1 b) d""",
    "junction_obs": """select k1, k2, k3, k4, k5, d + case when q = 49 then 4 else 0 end start,
  50 + (k4 % 3) * 40000 + case when q = 50 then k1 % 97 else 0 end gap,
  cast((k3 % 200 + k4 % 3) % 7 as int) motif, case when (k3 % 200) % 11 = 0 then 1 else 0 end annot, nh,
  least(10 + q, 5 + (q * 7) % 40) overhang
from (select l_orderkey k1, l_linenumber k2, l_partkey k3, l_suppkey k4, l_extendedprice k5, cast(l_quantity as bigint) q,
        (l_partkey % 200) * 1000 + (l_linenumber % 3) * 150 + 101 d,
        case when l_returnflag = 'R' then 2 else 1 end nh from lineitem) t""",
    "snps": """select cast(floor(p_partkey / 500.0) as int) % 5 chr, p_partkey * 1000 + (p_size * 37) % 900 pos, cast(p_partkey % 4 as int) ref,
  cast((p_partkey + 1) % 4 as int) a1, cast((p_partkey + p_size) % 4 as int) a2 from part""",
    "chain_blocks": """select cast(floor(p_partkey / 500.0) as int) % 5 chr, p_partkey * 1000 s1, p_partkey * 1100 + 7 s2, 500 + p_size * 9 len from part""",
    "umi_records": """select k4 cb, k3 % 40 feature, case when m = 0 then u else bxor(u, shl(1 + k2 % 3, 2 * (k1 % 6))) end umi
from (select l_orderkey k1, l_linenumber k2, l_partkey k3, l_suppkey k4, cast(l_quantity as int) % 2 m, (l_linenumber * 613) % 4096 u from lineitem) t""",
    "exons": """select o_custkey tr, o_custkey % 300 gene, o_orderkey, o_custkey * 100000 + (o_orderkey % 400) * 200 es,
  o_custkey * 100000 + (o_orderkey % 400) * 200 + 60 + o_orderkey % 200 ee from orders""",
}
TEXTS |= {
    # exons of genes: two of each part, and a third of every fourth
    "gene_exons": """select gene_id, chr, cast(gs + o * 400 as bigint) gs, cast(least(gs + o * 400 + 150 + gene_id % 90, ge + 900) as bigint) ge, strand
from (select p_partkey gene_id, cast(floor(p_partkey / 500.0) as int) % 5 chr, p_partkey * 1000 gs, p_partkey * 1000 + p_size * 40 ge, cast(p_partkey % 3 as int) strand from part) g
cross join (select 0 o union all select 1 o union all select 2 o) e where o < 2 or gene_id % 4 = 0""",
    # alignments of three blocks, a row a block: what follows a block, places, lengths, clips
    "pieces": """select k1, k2, k3, k4, k5, i, frag, len, r, g, kind, annot, lft, rgt, ref_len, read_length
from (select k1, k2, k3, k4, k5, i,
    case i when 0 then l0 when 1 then l1 else l2 end len, case when i = 2 and m1 = -3 or i >= 1 and m0 = -3 then 1 else 0 end frag,
    case i when 0 then c0 when 1 then c0 + l0 + x0 else c0 + l0 + x0 + l1 + x1 end r,
    case i when 0 then g0 when 1 then g0 + l0 + y0 else g0 + l0 + y0 + l1 + y1 end g,
    case i when 0 then m0 when 1 then m1 else -9 end kind, case i when 0 then a0 when 1 then a1 else 0 end annot,
    case i when 0 then k4 % 5 when 1 then k1 % 4 else 0 end lft, case i when 0 then k3 % 3 when 1 then k2 % 3 else 0 end rgt,
    c0 + l0 + x0 + l1 + x1 + l2 + k3 % 3 read_length, l0 + y0 + l1 + y1 + l2 ref_len
  from (select k1, k2, k3, k4, k5, l0, l1, l2, c0, g0, m0, m1, a0, a1,
      case when m0 = -2 then 1 + k3 % 3 when m0 = -3 then 1 else 0 end x0, case when m1 = -2 then 1 + k3 % 3 when m1 = -3 then 1 else 0 end x1,
      case when m0 >= 0 then 100 + k4 * 10 when m0 = -1 then 1 + k4 % 4 when m0 = -3 then k2 * 5 - 12 else 0 end y0,
      case when m1 >= 0 then 60 + k2 * 10 when m1 = -1 then 1 + k2 % 3 when m1 = -3 then k4 * 3 - 9 else 0 end y1
    from (select l_orderkey k1, l_linenumber k2, l_partkey k3, l_suppkey k4, l_extendedprice k5,
        cast(3 + l_quantity as bigint) % 23 + 1 l0, cast(4 + l_linenumber * 3 as bigint) l1, cast(2 + l_suppkey % 19 as bigint) l2, l_linenumber % 4 c0, l_partkey * 1000 + l_suppkey g0,
        cast(case when l_orderkey % 9 = 8 then -3 when l_orderkey % 9 = 7 then -2 when l_orderkey % 9 = 6 then -1 else l_orderkey % 7 end as int) m0,
        cast(case when l_orderkey % 9 = 8 then 1 when l_partkey % 5 = 0 then -3 when l_partkey % 5 = 1 then -1 else l_suppkey % 7 end as int) m1,
        cast(case when l_partkey % 3 = 0 and l_orderkey % 9 < 6 then 1 else 0 end as int) a0, cast(case when l_linenumber % 3 = 0 and l_partkey % 5 > 1 and l_orderkey % 9 < 8 then 1 else 0 end as int) a1
      from lineitem) b) c
  cross join (select 0 i union all select 1 i union all select 2 i) d) e""",
}
#: the columns of a line that k1 to k5 stand for
LINE_KEYS = {"lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def _calls(text: str, name: str, write) -> str:
    """Rewrites name(a, b), nested calls too."""
    while m := re.search(rf"\b{name}\(", text):
        depth, i, comma = 1, m.end(), 0
        while depth:
            depth += {"(": 1, ")": -1}.get(text[i], 0)
            if text[i] == "," and depth == 1:
                comma = i
            i += 1
        text = text[: m.start()] + write(text[m.end() : comma], text[comma + 1 : i - 1]) + text[i:]
    return text


def code_of(key: str) -> str:
    """Spark SQL of (key * 98245165300007 + 57885161) % 2^50 for keys from 0 on. The product of a key from 93 883 on is over 64 bits, so halves of 25 bits are multiplied."""
    low, high = f"(cast({key} as bigint) & 33554431)", f"(shiftrightunsigned(cast({key} as bigint), 25) & 33554431)"
    a, b = divmod(98_245_165_300_007, 1 << 25)
    return f"((({high} * {b}L + {low} * {a}L) & 33554431) * 33554432L + {low} * {b}L + 57885161L) % 1125899906842624L"


def spark_text(name: str) -> str:
    t = re.sub(r"\((\w+) \* 98245165300007 \+ 57885161\) % 1125899906842624", lambda m: code_of(m[1]), TEXTS[name])
    t = _calls(t, "shl", lambda a, n: f"shiftleft(cast({a} as bigint), cast({n} as int))")
    return _calls(t, "bxor", lambda a, b: f"(({a}) ^ ({b}))")


def duck_text(name: str) -> str:
    t = _calls(TEXTS[name], "shl", lambda a, n: f"(cast({a} as bigint) << cast({n} as int))")
    return _calls(t, "bxor", lambda a, b: f"xor({a}, {b})")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str, dealt: dict[str, list[str]] | None = None) -> DataFrame:
    """``dealt``: columns by which a table's rows are dealt out first, so that derived rows that share them are in one task."""
    text = spark_text(name)
    used = {t: table(spark, sf_dir, t) for t in TABLES if re.search(rf"\bfrom {t}\b", text)}
    used |= {t: used[t].repartition(*c) for t, c in (dealt or {}).items()}
    return spark.sql(re.sub(r"\bfrom (" + "|".join(used) + r")\b", r"from {\1}", text), **used)


def duck(*names: str) -> str:
    """The beginning of a DuckDB statement that defines these tables."""
    return "with recursive " + ", ".join(f"{n} as ({duck_text(n)})" for n in names)
