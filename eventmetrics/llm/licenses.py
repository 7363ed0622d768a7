"""Licences of files: notices compared with templates, and inheritance from directories above.

A notice is compared as a sparse TF-IDF vector, by cosine. Notices are the lines and the paragraphs of
any file that speak of a licence, all of these together, and the whole text of a licence file.
Equal notices are compared once, known by a hash of theirs. A file without a licence of its own
gets that of the nearest directory above it that holds a licence file, found by joins on the
directories' paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmetrics.llm.common import few, fresh, stored
from eventmetrics.llm.license_texts import TEMPLATES

MIN_SIMILARITY = 0.6
#: What a line or paragraph must have to be compared; every template has some of it.
NOTICE = (r"(?i)licen[cs]|copyright|spdx|hereby granted|redistribut|rights reserved|public domain"
          r"|free software|neither the name")
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)[^/]*$"
#: Between paragraphs: lines without a letter or digit, as comments have them, too.
PARAGRAPH = r"\n(?:[^\p{L}\p{N}\n]*\n)+"
TOKEN = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Says who has the rights, and is no licence: any licence beside it counts more.
PROPRIETARY = "Proprietary"


def _notices(path: Column, text: Column) -> Column:
    """The notices of a file: lines, paragraphs, all of these together, and a licence file's text."""
    none = F.array().cast("array<string>")
    speaks = text.rlike(NOTICE)
    lines = F.filter(F.split(text, "\n"), lambda part: part.rlike(NOTICE))
    paragraphs = F.filter(F.split(text, PARAGRAPH), lambda part: part.rlike(NOTICE))
    together = F.array(F.array_join(paragraphs, "\n\n"))
    found = F.concat(lines, paragraphs, together)
    whole = F.when(path.rlike(LICENCE_FILE), F.array(text)).otherwise(none)
    # Few texts have any: one pass over the text finds that out.
    return F.array_distinct(F.coalesce(F.concat(
        F.when(speaks, found).otherwise(none), whole), none))


def _tokens(notices: DataFrame, key: str) -> DataFrame:
    words = F.explode(F.regexp_extract_all(F.lower("notice"), F.lit(f"({TOKEN})"), 1))
    return notices.select(key, words.alias("token")).groupBy(key, "token").agg(
        F.count("*").alias("tf"))


def _rank(similarity: Column, license: Column) -> Column:
    """The least is best: a licence before a mere claim, then the most similar, then by name."""
    return F.struct(license == PROPRIETARY, -similarity, license)


def match_notices(notices: DataFrame, templates=TEMPLATES,
                  min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """notice, license and similarity of the distinct texts `notice` that match a template.

    Weights are tf * (ln((1 + texts) / (1 + df)) + 1), counted over the distinct notices and the
    templates. Of equal similarities (to six decimals) the first licence by name is taken.
    """
    spark = notices.sparkSession
    known = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)],
                                  "template int, license string, notice string")
    # A token's row has a hash of the notice and not the notice, which may be long.
    distinct = stored(notices.filter("notice is not null").select(
        F.sha2("notice", 256).alias("key"), "notice").dropDuplicates(["key"]))
    tokens = stored(_tokens(distinct, "key"))
    of_templates = stored(_tokens(known, "template"))
    texts = distinct.count() + len(templates)
    df = stored(tokens.select("token").unionByName(of_templates.select("token"))
                .groupBy("token").agg(F.count("*").alias("df")))
    weight = (F.col("tf") * (F.log(F.lit(1.0 + texts) / (1 + F.col("df"))) + 1)).alias("weight")
    weights = stored(tokens.join(few(df), "token").select("key", "token", weight))
    template_weights = stored(of_templates.join(df, "token").select("template", "token", weight))
    norms = weights.groupBy("key").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    template_norms = template_weights.groupBy("template").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("template_norm"))
    # The templates are fixed and few, so they may be sent to every task.
    side = template_weights.withColumnRenamed("weight", "template_weight")
    dots = (weights.join(F.broadcast(side), "token").groupBy("key", "template").agg(
        F.sum(F.col("weight") * F.col("template_weight")).alias("dot")))
    scored = (dots.join(F.broadcast(template_norms), "template").join(norms, "key")
              .join(F.broadcast(known.select("template", "license")), "template")
              .select("key", "license", F.round(
                  F.col("dot") / F.col("norm") / F.col("template_norm"), 6).alias("similarity")))
    best = F.min_by(F.struct("license", "similarity"), F.struct(-F.col("similarity"), F.col("license")))
    found = stored(scored.groupBy("key").agg(best.alias("best")).filter(
        F.col("best.similarity") >= min_similarity).select("key", "best.*"))
    return distinct.join(few(found), "key").select("notice", "license", "similarity")


def _directory(path: Column) -> Column:
    """The directory of a path; the top directory is an empty text."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan_licenses(files: DataFrame, path: str = "path", text: str = "text", templates=TEMPLATES,
                  min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """The rows with four more columns: license, license_basis, license_similarity, license_source.

    The basis is `own` (from the file's notices; the source is its path), `inherited` (the source is
    the directory whose licence file counts) or `none`, with nulls. Of a file's notices, and of a
    directory's licence files, the most similar decides, and of equal ones the first licence by
    name; `Proprietary` counts only if nothing else does. A null or empty text has no notice; a file with a null path inherits nothing. Repeated
    rows get the same result. A column that exists already gets a trailing underscore here.
    """
    names = [fresh(files, c) for c in
             ("license", "license_basis", "license_similarity", "license_source")]
    key, place, own_best, their_best = (fresh(files, c) for c in (
        "row_of_file", "directory_of_file", "own_best", "their_best"))
    # A file is known by its path and text, so that rows without either, or repeated ones, are fine.
    of_file = [F.col(path).isNull(), F.col(path), F.col(text)]
    keyed = files.withColumn(key, F.concat_ws(
        "-", F.hex(F.xxhash64(*of_file)), F.hex(F.xxhash64(F.lit(1), *of_file))))
    read = stored(keyed.select(
        F.col(key).alias("file"), F.col(path).alias("path"),
        _notices(F.coalesce(F.col(path), F.lit("")), F.col(text)).alias("notices")))
    notices = stored(read.select("file", "path", F.explode("notices").alias("notice"))
                     .select("file", "path", F.sha2("notice", 256).alias("key"), "notice").distinct())
    matched = match_notices(notices.select("notice"), templates, min_similarity)
    matched = stored(matched.select(F.sha2("notice", 256).alias("key"), "license", "similarity"))
    rank = _rank(F.col("similarity"), F.col("license"))
    best = F.min_by(F.struct("license", "similarity"), rank).alias("best")
    own = stored(notices.select("file", "path", "key").join(few(matched), "key")
                 .groupBy("file", "path").agg(best).select("file", "path", "best.*"))
    directories = (own.filter(F.col("path").rlike(LICENCE_FILE))
                   .groupBy(_directory(F.col("path")).alias("above")).agg(best)
                   .select("above", "best.license", "best.similarity"))
    # Every distinct directory meets the directories above it, itself included.
    places = read.filter("path is not null").select(
        _directory(F.col("path")).alias("directory")).distinct()
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)),
                        lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    chains = places.select("directory", F.explode(F.array_distinct(above)).alias("above"))
    inherited = stored(chains.join(directories, "above").groupBy("directory").agg(
        F.max_by(F.struct("license", "similarity", F.col("above").alias("source")),
                 F.length("above")).alias(their_best)).withColumnRenamed("directory", place))
    mine = stored(own.groupBy("file").agg(F.min_by(F.struct("license", "similarity"), rank).alias(own_best))
                  .withColumnRenamed("file", key))
    joined = (keyed.withColumn(place, _directory(F.col(path)))
              .join(few(mine), key, "left").join(few(inherited), place, "left"))
    has_own, has_theirs = F.col(own_best).isNotNull(), F.col(their_best).isNotNull()
    return joined.select(
        *files.columns,
        F.coalesce(f"{own_best}.license", f"{their_best}.license").alias(names[0]),
        F.when(has_own, "own").when(has_theirs, "inherited").otherwise("none").alias(names[1]),
        F.coalesce(f"{own_best}.similarity", f"{their_best}.similarity").alias(names[2]),
        F.when(has_own, F.col(path)).when(has_theirs, F.col(f"{their_best}.source")).alias(names[3]))
