"""Licence scans by DataFrame functions alone: sparse TF-IDF cosine of headers to templates, then inheritance from the nearest ancestor directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

LEAST = 0.6
CUE = r"(?i)licen[cs]|copyright|copyleft|permission is|redistribution|warrant(y|ies)|spdx|public domain|rights reserved"
CUT = r"\n|\. "
NAMED = r"(?i)(^|/)(licen[cs]e|copying)([._-][^/]*)?$"
TOKEN = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"

#: SPDX names and usual sentences of headers and licence files.
TEMPLATES = [
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "You may not use this file except in compliance with the License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0"),
    ("Proprietary", "Copyright, all rights reserved, use without permission is prohibited"),
    ("Proprietary", "All rights reserved"),
]


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def scan(files: DataFrame, text: str = "text") -> DataFrame:
    """``files`` with ``_headers``: their header sentences, and whether the first sentence is one. A header is a sentence (a line, cut at full stops followed by a blank) with a cue word, anywhere in the whole text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    parts = F.when(whole.rlike(CUE), F.split(whole, CUT, -1)).otherwise(F.array().cast("array<string>"))
    return files.withColumns({"_headers": F.filter(parts, lambda s: s.rlike(CUE)), "_opens": F.get(parts, F.lit(0)).rlike(CUE)})


def match(headers: DataFrame, least: float = LEAST) -> DataFrame:
    """(header, licence, score) of distinct ``header`` strings with their number of ``uses``: the template of the highest cosine of tf * idf, if that is ``least`` or more; of equal ones the first name. idf = ln((1 + headers) / (1 + headers with the term)) + 1, over all headers, repeated ones too."""
    spark = headers.sparkSession
    terms = headers.select("header", "uses", F.explode(tokens(F.col("header"))).alias("term")).groupBy("header", "uses", "term").agg(F.count("*").cast("double").alias("tf"))
    total = headers.agg(F.coalesce(F.sum("uses"), F.lit(0)).cast("double").alias("total"))
    used = terms.groupBy("term").agg(F.sum("uses").cast("double").alias("df"))
    idf = lambda df, n: F.log((n + 1) / (df + 1)) + 1
    vectors = terms.join(used, "term").join(F.broadcast(total)).select("header", "term", (F.col("tf") * idf(F.col("df"), F.col("total"))).alias("w"))
    norms = vectors.groupBy("header").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    fixed = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(TEMPLATES)], "template int, licence string, sentence string")  # as large as TEMPLATES
    model = fixed.select("template", "licence", F.explode(tokens(F.col("sentence"))).alias("term")).groupBy("template", "licence", "term").agg(F.count("*").cast("double").alias("tf"))
    model = model.join(used, "term", "left").join(F.broadcast(total)).select("template", "licence", "term", (F.col("tf") * idf(F.coalesce("df", F.lit(0.0)), F.col("total"))).alias("v"))
    sizes = model.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("size"))
    dots = vectors.join(F.broadcast(model), "term").groupBy("header", "template", "licence").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    scored = dots.join(norms, "header").join(F.broadcast(sizes), "template").select("header", "licence", F.round(F.col("dot") / (F.col("norm") * F.col("size")), 6).alias("score")).where(F.col("score") >= least)
    best = scored.groupBy("header").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("licence"))).alias("best"))
    return best.select("header", F.col("best.licence").alias("licence"), (-F.col("best.s")).alias("score"))


def licences(files: DataFrame, scratch: Scratch, key: str = "doc_id", path: str = "path", text: str = "text", least: float = LEAST) -> DataFrame:
    """(doc_id, path, licence, score, how, origin) for each row.

    A file with a matching header has that licence (of several the best score, then the first name; a reservation of rights, Proprietary, only where no licence is named, as licence texts hold it too): ``how`` is header. A file that opens with a matching header, or is named LICENSE or COPYING and has one, is its directory's licence file; of several the one of the smallest path, then key. Other files inherit from the nearest directory above them that has a licence file: ``inherited``, with that directory as ``origin``; else ``none``.
    Paths are slash-separated; null or empty ones have no directory, as have names without a slash. Null texts have no header. Repeated rows give repeated results. Equal headers are matched once, so a very common line costs a count; the join to directories is by equality of paths, an ancestor each."""
    # the texts are read once: what is left of them is their header sentences
    rows = scratch.save(scan(files.select(F.col(key).alias("doc_id"), F.col(path).alias("path"), F.col(text).alias("text"))).drop("text"))
    single = rows.where(F.size("_headers") > 0).select("doc_id", "path", "_opens", F.posexplode("_headers").alias("at", "header"))
    matched = match(scratch.save(single.groupBy("header").agg(F.count("*").alias("uses"))), least)
    reserved = (F.col("licence") == "Proprietary").alias("reserved")
    found = single.join(matched, "header").groupBy("doc_id", "path").agg(
        F.min(F.struct(reserved, (-F.col("score")).alias("s"), F.col("licence"))).alias("best"), F.min(F.when(F.col("_opens") & (F.col("at") == 0), F.struct((-F.col("score")).alias("s"), F.col("licence")))).alias("file")
    )
    found = scratch.save(found.select("doc_id", "path", "best.licence", (-F.col("best.s")).alias("score"), F.coalesce("file.licence", F.when(F.col("path").rlike(NAMED), F.col("best.licence"))).alias("opening")))
    folder = lambda p: F.when(F.instr(p, "/") > 0, F.regexp_replace(p, "/[^/]*$", ""))
    files_ = found.where("opening is not null").select(folder(F.col("path")).alias("origin"), "path", "doc_id", "opening").where("origin is not null")
    folders = files_.groupBy("origin").agg(F.min(F.struct("path", "doc_id", "opening")).alias("f")).select("origin", F.col("f.opening").alias("inherited"))
    plain = rows.select("doc_id", "path", folder(F.col("path")).alias("dir"))
    steps = F.split("dir", "/", -1)
    above = plain.select("dir").where("dir is not null").distinct().select("dir", F.posexplode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))).alias("depth", "origin"))
    nearest = above.join(folders, "origin").groupBy("dir").agg(F.max(F.struct("depth", "origin", "inherited")).alias("n")).select("dir", "n.origin", "n.inherited")
    own = found.select(F.col("doc_id").alias("d"), F.col("path").alias("p"), "licence", "score")
    out = plain.join(own, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("path").eqNullSafe(F.col("p")), "left").join(nearest, "dir", "left")
    how = F.when(F.col("licence").isNotNull(), "header").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    return out.select("doc_id", "path", F.coalesce("licence", "inherited").alias("licence"), "score", how.alias("how"), F.when(how == "inherited", F.col("origin")).alias("origin"))


def query(spark, sf_dir: str) -> DataFrame:
    """The documents as files of their source's tree, at its thousands, hundreds or twenties by turns of their numbers. Those with a cue stand as LICENSE files of a thousand or a hundred, so that files beside and below inherit from the nearest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    step = lambda name, n: F.concat(F.lit(name), F.expr(f"doc_id div {n}"))
    cued = F.coalesce(F.col("text").rlike(CUE), F.lit(False))
    depth = F.when(F.col("cued"), F.expr("doc_id % 2")).otherwise(F.expr("doc_id div 3 % 3"))
    name = F.concat(F.when(F.col("cued"), "LICENSE.").otherwise("f"), F.col("doc_id"))
    path = F.concat_ws("/", F.col("source"), step("t", 1000), F.when(F.col("depth") > 0, step("h", 100)), F.when(F.col("depth") > 1, step("g", 20)), name)
    return licences(docs.select("doc_id", "text", "source", cued.alias("cued")).withColumn("depth", depth).select("doc_id", "text", path.alias("path")), Scratch(spark))


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    fixed = ", ".join(f"({i}, {quote(n)}, {quote(t)})" for i, (n, t) in enumerate(TEMPLATES))
    return rf"""
with fixed(template, licence, sentence) as (values {fixed}),
c as (select *, coalesce(regexp_matches(text, '{CUE}'), false) cued from documents), e as (select *, case when cued then doc_id % 2 else doc_id // 3 % 3 end depth from c),
d as (select doc_id, concat_ws('/', source, 't' || (doc_id // 1000), case when depth > 0 then 'h' || (doc_id // 100) end, case when depth > 1 then 'g' || (doc_id // 20) end, case when cued then 'LICENSE.' else 'f' end || doc_id) path,
  regexp_split_to_array(coalesce(text, ''), '{CUT}') parts from e),
s as (select doc_id, path, parts[1] = u header_first, u header, i from (select doc_id, path, parts, unnest(parts) u, generate_subscripts(parts, 1) i from d) where regexp_matches(u, '{CUE}')),
h as (select header, count(*) uses from s group by header),
t as (select header, uses, term, count(*) tf from (select header, uses, unnest(regexp_extract_all(lower(header), '{TOKEN}')) term from h) group by all),
n as (select coalesce(sum(uses), 0) total from h), f as (select term, sum(uses) df from t group by term),
v as (select header, term, tf * (ln((total + 1) / (df + 1.0)) + 1) w from t join f using (term), n),
m as (select template, licence, term, count(*) tf from (select template, licence, unnest(regexp_extract_all(lower(sentence), '{TOKEN}')) term from fixed) group by all),
mv as (select template, licence, term, tf * (ln((total + 1) / (coalesce(df, 0) + 1.0)) + 1) v from m left join f using (term), n),
dots as (select header, template, licence, sum(w * v) dot from v join mv using (term) group by all),
sc as (select header, licence, round(dot / (a.norm * b.size), 6) score from dots join (select header, sqrt(sum(w * w)) norm from v group by header) a using (header) join (select template, sqrt(sum(v * v)) size from mv group by template) b using (template)),
best as (select header, licence, score from sc where score >= {LEAST} qualify row_number() over (partition by header order by score desc, licence) = 1),
hit as (select s.doc_id, s.path, s.i, best.licence, best.score from s join best using (header)),
own as (select doc_id, path, licence, score from hit qualify row_number() over (partition by doc_id order by licence = 'Proprietary', score desc, licence) = 1),
first as (select doc_id, licence from hit where i = 1 qualify row_number() over (partition by doc_id order by score desc, licence) = 1),
opening as (select own.doc_id, own.path, coalesce(first.licence, case when regexp_matches(own.path, '{NAMED}') then own.licence end) licence from own left join first using (doc_id)),
folders as (select regexp_replace(path, '/[^/]*$', '') origin, licence inherited from opening where licence is not null qualify row_number() over (partition by origin order by path, doc_id) = 1),
p as (select doc_id, path, regexp_replace(path, '/[^/]*$', '') dir from d),
near as (select doc_id, origin, inherited from p join folders on dir = origin or starts_with(dir, origin || '/') qualify row_number() over (partition by doc_id order by length(origin) desc) = 1)
select p.doc_id, p.path, coalesce(own.licence, near.inherited) licence, own.score score,
  case when own.licence is not null then 'header' when near.inherited is not null then 'inherited' else 'none' end how,
  case when own.licence is null then near.origin end origin
from p left join own using (doc_id) left join near using (doc_id)
"""


SQL = _sql()
