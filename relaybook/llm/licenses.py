"""License scans: TF-IDF cosine to templates, and inheritance from the nearest directory above."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaybook.llm.common import carried, let, stash

THRESHOLD = 0.7
#: Names of licence files, whose licence holds for their directory and those below it.
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"
_TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: Where one header statement ends: a line, or a sentence.
_UNIT = r"\n+|(?<=[.!?])[ \t\r]+"
#: Where a paragraph ends (an empty line), and a run of lines with letters or digits.
_PARAGRAPH = r"\n[ \t\r\n]*\n"
_STANZA = r"\n[^A-Za-z0-9]*\n"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_TERM), F.lit(0))


def directory(path: Column) -> Column:
    """All before the last slash; a path without one lies in the root, the empty string."""
    return F.when(F.instr(path, "/") == 0, F.lit("")).otherwise(F.regexp_replace(path, "/[^/]*$", ""))


def _file(path: Column, text: Column) -> Column:
    """What tells files apart: their path and text."""
    return F.sha2(F.concat_ws("\n", F.coalesce(F.concat(F.lit("="), path), F.lit("-")), text), 256)


def _idf(df: Column, documents: int) -> Column:
    return F.log((F.lit(documents) + 1.0) / (df + 1.0)) + 1.0


def document_frequencies(files: DataFrame, text: str) -> tuple[DataFrame, int]:
    """(term, df) of all terms of all files, written to disk, and the number of files.

    Tasks count their terms before the shuffle, so it carries vocabularies and no texts.
    """
    found = F.array_distinct(terms(F.col(text)))
    one = F.explode(F.concat(found, F.array(F.lit(None).cast("string"))))
    seen = stash(files.select(one.alias("term")).groupBy("term").agg(F.count("*").alias("df")), "license-df")
    documents = next((row.df for row in seen.filter("term IS NULL").collect()), 0)
    return seen.filter("term IS NOT NULL"), documents


def template_weights(templates: DataFrame, seen: DataFrame, documents: int) -> DataFrame:
    """(license, template, term, tf, idf, weight) with weights of length 1."""
    numbered = templates.filter(F.col("license").isNotNull()).select(
        "license", F.xxhash64("license", "text").alias("template"), F.explode(terms(F.col("text"))).alias("term")
    )
    counts = stash(numbered.groupBy("license", "template", "term").agg(F.count("*").alias("tf")),
                   "license-templates")
    weighted = counts.join(seen, "term", "left").withColumn(
        "idf", _idf(F.coalesce("df", F.lit(0)), documents)
    ).withColumn("raw", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("license", "template")))
    return weighted.select("license", "template", "term", "tf", "idf", (F.col("raw") / length).alias("weight"))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in sorted(values)]).cast("array<string>")


def anchors(weights: DataFrame, threshold: float) -> DataFrame:
    """Terms of which a text must have one to reach the threshold with some template.

    The commonest terms of a template whose weights together are shorter than the threshold can not
    reach it by themselves; all others are anchors.
    """
    rising = Window.partitionBy("license", "template").orderBy("idf", "term")
    below = F.sum(F.col("weight") * F.col("weight")).over(rising)
    return weights.withColumn("below", below).filter(
        F.col("below") >= threshold * threshold - 1e-9
    ).select("term").distinct()


def shapes(rows: list) -> Column:
    """The templates as an array of (license, template, size, known): number of terms, and their weights and idfs."""
    made: dict[tuple, dict] = {}
    for row in rows:
        shape = made.setdefault((row.license, row.template), {
            "license": row.license, "template": row.template, "size": 0, "known": {}})
        shape["size"] += row.tf
        shape["known"][row.term] = {"weight": row.weight, "idf": row.idf}
    known = "map<string,struct<weight:double,idf:double>>"
    kind = f"array<struct<license:string,template:bigint,size:int,known:{known}>>"
    return F.from_json(F.lit(json.dumps(list(made.values()))), kind)


def coverage(shape: Column, words: Column) -> Column:
    """The squared weights of a template's terms that are among words.

    No text scores more with the template than the root of this.
    """
    known = shape["known"]
    met = F.array_intersect(F.map_keys(known), words)
    return F.aggregate(met, F.lit(0.0), lambda total, term: total + F.pow(F.element_at(known, term)["weight"], F.lit(2)))


def bound(shape: Column, words: Column) -> Column:
    """What words score with a template at most: each word that is not of it weighs 1 at least, as idfs do."""
    met = F.transform(F.array_intersect(F.map_keys(shape["known"]), words), lambda term: F.struct(
        F.size(F.filter(words, lambda word: word == term)).cast("double").alias("n"),
        F.element_at(shape["known"], term).alias("of"),
    ))
    zero = F.struct(*[F.lit(0.0).alias(name) for name in ("product", "square", "n")])
    sums = F.aggregate(met, zero, lambda total, term: F.struct(
        (total["product"] + term["n"] * term["of"]["idf"] * term["of"]["weight"]).alias("product"),
        (total["square"] + F.pow(term["n"] * term["of"]["idf"], F.lit(2))).alias("square"),
        (total["n"] + term["n"]).alias("n"),
    ))
    return let(sums, lambda s: s["product"] / F.sqrt(F.greatest(s["square"] + F.size(words) - s["n"], F.lit(1.0))))


def able_unit(shape: Column, words: Column, threshold: float) -> Column:
    return (coverage(shape, words) >= threshold * threshold - 1e-9) & (bound(shape, words) >= threshold - 1e-9)


def blocks(text: Column, is_license: Column) -> Column:
    """Terms of the parts of a text: lines and sentences, paragraphs, runs of lines with letters, and
    a licence file as a whole."""
    whole = F.when(is_license, F.array(text)).otherwise(F.array().cast("array<string>"))
    parts = F.array_union(F.array_union(F.split(text, _UNIT), F.split(text, _PARAGRAPH)),
                          F.array_union(F.split(text, _STANZA), whole))
    return F.transform(parts, terms)


def windows(shape: Column, words: Column, threshold: float) -> Column:
    """Runs of words as long as the template where what they share with it peaks.

    A run may begin at every place, over the ends of lines and sentences and inside of these. A run's
    share is the sum of idf times weight over its words; of runs that begin side by side, those count
    that share more than the one before and no less than the one after, so a notice is met at its first
    word wherever it stands. Runs that can not reach the threshold are left out by a bound of the cosine.
    """
    size = shape["size"]
    nothing = F.struct(F.lit(0.0).alias("product"), F.lit(1.0).alias("square"))
    worth = F.transform(words, lambda word: F.coalesce(
        let(F.element_at(shape["known"], word), lambda of: F.when(of.isNotNull(), F.struct(
            (of["idf"] * of["weight"]).alias("product"), F.greatest(of["idf"] * of["idf"], F.lit(1.0)).alias("square"),
        ))), nothing,
    ))

    def summed(values: Column) -> Column:
        places = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda at: F.aggregate(
            F.slice(values, at, size), nothing.withField("square", F.lit(0.0)),
            lambda sums, one: F.struct((sums["product"] + one["product"]).alias("product"),
                                       (sums["square"] + one["square"]).alias("square")),
        ))

    def peaks(sums: Column) -> Column:
        places = F.transform(sums, lambda here, i: F.struct((i + 1).alias("at"), (
            (here["product"] >= (threshold - 1e-9) * F.sqrt(F.greatest(here["square"], F.lit(1.0))))
            & ((i == 0) | (here["product"] > F.get(sums, i - 1)["product"]))
            & (here["product"] >= F.coalesce(F.get(sums, i + 1)["product"], F.lit(0.0)))
        ).alias("peak")))
        return F.transform(F.filter(places, lambda place: place["peak"]), lambda place: place["at"])

    begun = let(let(worth, summed), peaks)
    met = F.filter(begun, lambda at: able_unit(shape, F.slice(words, at, size), threshold))
    return F.transform(met, lambda at: F.slice(words, at, size))


def scan_licenses(
    files: DataFrame, templates: DataFrame, path: str = "path", text: str = "text",
    threshold: float = THRESHOLD, carry: list[str] | None = None,
) -> DataFrame:
    """Files with ``header_license``, ``header_score``, ``inherited_license``, ``inherited_from`` and
    ``license``.

    ``templates`` has (license, text). Every line, sentence and paragraph of a file is a unit, so is
    the whole text of a licence file, and so are the runs of words as long as the template, over the
    ends of lines and inside of them, that share most with it (``windows``); the best cosine of a unit and
    a template counts if it is ``threshold`` or more, ties by name. Every term weighs by the number of files that hold it, be it of a template or
    not. Licence files give theirs to the directory they are in (the best score, ties by name). A file without a licence of its own has
    that of the nearest directory at or above its own.

    Files are filtered by anchor terms inside the scan, then files and units by how much of a template
    they hold; both are bounds of the cosine, so no unit that reaches the threshold is lost. Only terms of
    units that can match are shuffled. Directories are resolved once each.

    Null and empty texts have no header. A null path has no directory and inherits nothing; the
    licence in such a row still counts for itself. Rows with one path and text are scanned once and
    all get the result. An empty table gives an empty one. ``carry`` names the columns of ``files`` to return (default: all); texts that
    are not carried are not shuffled. Columns of the input with the names of result columns are
    replaced.
    """
    added = ("header_license", "header_score", "inherited_license", "inherited_from", "license")
    # Other files lie in directories and hold texts too, so only these two columns are looked at.
    plain = files.select(F.col(path).alias("path"), F.col(text).alias("text"))
    seen, documents = document_frequencies(plain, "text")
    weights = stash(template_weights(templates, seen, documents), "license-weights")
    needed = [row.term for row in anchors(weights, threshold).collect()]
    able = plain.filter(F.arrays_overlap(terms(F.col("text")), _strings(needed)))
    marked = able.withColumn("file", _file(F.col("path"), F.col("text"))).withColumn("is_license", F.coalesce(
        F.regexp_like(F.substring_index("path", "/", -1), F.lit(LICENSE_FILE)), F.lit(False)
    )).withColumn("words", terms(F.col("text")))
    # The templates are a parameter and do not grow with the files.
    templated, floor = shapes(weights.collect()), threshold * threshold - 1e-9
    pairs = marked.withColumn("shape", F.explode(
        F.filter(templated, lambda shape: coverage(shape, F.col("words")) >= floor)
    ))
    shape = F.col("shape")
    near = F.filter(blocks(F.col("text"), F.col("is_license")), lambda block: able_unit(shape, block, threshold))
    runs = windows(shape, F.col("words"), threshold)
    units = pairs.select("file", "path", "is_license", "shape.license", "shape.template", F.explode(
        F.array_distinct(F.concat(near, runs))).alias("terms"))
    by_unit = ["file", "path", "is_license", "license", "template", "unit"]
    counted = units.withColumn("unit", F.xxhash64("terms")).withColumn("term", F.explode("terms")).groupBy(
        *by_unit, "term"
    ).agg(F.count("*").alias("tf"))
    # A unit's terms are terms of its file, so each of them has been counted.
    raw = counted.join(seen, "term").withColumn("raw", F.col("tf") * _idf(F.col("df"), documents))
    weighed = raw.join(weights.select("license", "template", "term", "weight"), ["license", "template", "term"], "left")
    scored = weighed.groupBy(*by_unit).agg(
        (F.sum(F.col("raw") * F.coalesce("weight", F.lit(0.0))) / F.sqrt(F.sum(F.col("raw") * F.col("raw")))).alias("score")
    )
    # Rounded, so that the order of a sum does not decide a tie.
    best = scored.withColumn("score", F.round(F.least("score", F.lit(1.0)), 9)).filter(
        F.col("score") >= threshold
    ).groupBy("file").agg(
        F.min(F.struct((-F.col("score")).alias("less"), F.col("license"))).alias("best"),
        F.first("path").alias("path"), F.first("is_license").alias("is_license"),
    ).select("file", "path", "is_license", F.col("best.license").alias("header_license"),
             (-F.col("best.less")).alias("header_score"))
    best = stash(best, "license-headers")
    own = best.filter(F.col("is_license") & F.col("path").isNotNull()).groupBy(
        directory(F.col("path")).alias("above")
    ).agg(F.min(F.struct((-F.col("header_score")).alias("less"), F.col("header_license"))).alias("best")).select(
        "above", F.col("best.header_license").alias("inherited_license")
    )
    folders = plain.filter(F.col("path").isNotNull()).select(directory(F.col("path")).alias("folder")).distinct()
    parts = F.split("folder", "/")
    ladder = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")
    ))
    steps = folders.select("folder", F.explode(ladder).alias("step")).select("folder", "step.depth", "step.above")
    nearest = steps.join(own, "above").groupBy("folder").agg(
        F.max(F.struct("depth", "above", "inherited_license")).alias("near")
    ).select("folder", F.col("near.inherited_license"), F.col("near.above").alias("inherited_from"))
    whole = files.select(
        carried(files, carry, *added).alias("row"), F.col(path).alias("own_path"),
        _file(F.col(path), F.col(text)).alias("own_file"),
    ).withColumn("folder", directory(F.col("own_path")))
    headers = best.select(F.col("file").alias("own_file"), "header_license", "header_score")
    result = whole.join(headers, "own_file", "left").join(nearest, "folder", "left")
    return result.select(
        "row.*", "header_license", "header_score", "inherited_license", "inherited_from",
        F.coalesce("header_license", "inherited_license").alias("license"),
    )
