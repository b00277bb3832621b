"""Reading transcription files: ordered lines to pages and loci.

Files are read in their splits, so a file of any size is read in parallel, and
lines are numbered over the splits. Everything positional is a running value
over the lines of a file: the pages so far, the header last met, the loci before
it. Such values run within a split, and what a split starts with is carried from
the ends of the splits before it, one row each. Frames of lines without splits
are windows over files. A page is a header's occurrence (``page_ord``), not its
id: a repeated header opens a new page and its lines count from 1 again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import MalformedLocusError, MissingPageContextError
from ..functions.text import strip
from .shared import compiled

FORMAT = r"^#=IVTFF\s+(\S+)\s*(.*)$"
COMMENT = r"^#(.*)$"
PAGE = r"^<(f[0-9]+[rv][0-9]*)>\s*(.*)$"
VALUE = r"[^\s$>]+"
LOCUS = r"^<(f[0-9]+[rv][0-9]*)\.([0-9]+),([+@=*]?)([PLCR])([0-9]*)(?:;([A-Z]))?>(.*)$"
FILE_BREAKS = r"\r\n|\r|\n"
TEXT_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
# The header's variables.
VARIABLES = {"Q": "quire", "P": "page_in_quire", "F": "folio", "B": "bifolio", "I": "illustration", "L": "language", "H": "hand", "C": "cluster", "X": "extraneous"}
NUMERIC = ("bifolio", "cluster")


#: Files up to which what numbers their splits, a row each, goes to all tasks.
FEW_FILES = 10_000


def _numbered(texts: DataFrame, breaks: str) -> DataFrame:
    return texts.select("file", F.posexplode(F.split("value", breaks)).alias("at", "line")).select("file", (F.col("at") + 1).alias("line_no"), "line")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, line_no, line`` of text files, and the ``split`` a line is of; bytes that are no UTF-8 become U+FFFD."""
    texts = spark.read.text(paths)
    rows = texts.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), F.make_valid_utf8("value").alias("line"))
    # Lines of a split are numbered without gaps; one row a split is summed over its file.
    sizes = rows.groupBy("file", "split").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", "split", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    if len(texts.inputFiles()) <= FEW_FILES:
        # Lines stay in the task that reads them; otherwise all of them would be shuffled and sorted by their files' names.
        bases = F.broadcast(bases)
    return rows.join(bases, ["file", "split"]).select("file", (F.col("at") - F.col("first") + F.col("base") + 1).alias("line_no"), "line", "split")


def lines_of(texts: DataFrame) -> DataFrame:
    """The same of a frame of ``file, value``; breaks are those of Unicode text."""
    return _numbered(texts, TEXT_BREAKS)


def header_variables(header: Column) -> Column:
    """Struct of a page header's nine variables; of a repeated one the last counts."""

    def last(letter: str, name: str) -> Column:
        # One pass a variable: what stands before its last occurrence is passed over at once.
        found = F.regexp_extract_all(header, F.lit(rf"^.*\${letter}=({VALUE})"), 1)
        if name in NUMERIC:
            return F.get(F.regexp_extract_all(F.get(found, 0), F.lit("^([0-9]+)$"), 1), 0).try_cast("int")
        return F.get(found, 0)

    return F.struct(*(last(letter, name).alias(name) for letter, name in VARIABLES.items()))


def classify(lines: DataFrame) -> DataFrame:
    """``kind`` of every line: blank, format, comment, page, locus or other, in that order."""
    line = F.col("line")
    kind = (
        F.when(line.rlike(r"(?U)^\s*$"), "blank")
        .when(line.rlike(FORMAT), "format")
        .when(line.rlike(COMMENT), "comment")
        .when(line.rlike(PAGE), "page")
        .when(line.rlike(LOCUS), "locus")
        .otherwise("other")
    )
    return lines.withColumn("kind", kind)


def placed(lines: DataFrame, with_page: bool = False) -> DataFrame:
    """Classified lines with their page and comment group.

    ``page_ord`` numbers the headers of a file, 0 before the first, and
    ``line_index`` counts the loci since the last one. ``with_page`` adds that
    header's ``page_id`` and ``variables``, which are parsed at the header alone
    and carried from there. ``island`` counts the accepted pages and loci before
    a line: comments go to the next one.
    """
    split = ["split"] if "split" in lines.columns else []
    before = Window.partitionBy("file", *split).orderBy("line_no")
    upto = before.rowsBetween(Window.unboundedPreceding, 0)
    is_page, is_locus = F.col("kind") == "page", F.col("kind") == "locus"
    seen = classify(compiled(lines)).withColumn("pages_", F.sum(is_page.cast("int")).over(upto)).withColumn("loci_", F.sum(is_locus.cast("int")).over(upto))
    # Each is a column of its own, so that what a query does not use is pruned.
    page = _page_columns("line") if with_page else {}
    carries = {"last_": F.col("loci_")} | {f"{name}_": column for name, column in page.items()}
    seen = seen.withColumns({name: F.last(F.when(is_page, column), True).over(upto) for name, column in carries.items()})
    seen = seen.withColumn("first_", F.first(F.when(is_page, F.col("loci_")), True).over(upto))
    if split:
        ends = seen.groupBy("file", "split").agg(F.max_by(F.struct("pages_", "loci_", "first_", *carries), "line_no").alias("end"))
        earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
        sums = ends.select("file", "split", "end.*", *(F.coalesce(F.sum(f"end.{x}_").over(earlier), F.lit(0)).alias(f"{x}0") for x in ("pages", "loci")))
        sums = sums.withColumns({"last_": F.col("last_") + F.col("loci0"), "first_": F.col("first_") + F.col("loci0")})
        carried = sums.select("file", "split", "pages0", "loci0", F.first("first_", True).over(earlier).alias("first0"), *(F.last(x, True).over(earlier).alias(f"{x}0") for x in carries))
        seen = seen.join(carried, ["file", "split"])
        here = {x: F.col(x) for x in carries} | {"last_": F.col("last_") + F.col("loci0")}
        seen = seen.withColumns({"pages_": F.col("pages_") + F.col("pages0"), "first_": F.coalesce("first0", F.col("first_") + F.col("loci0")), "loci_": F.col("loci_") + F.col("loci0"), **{x: F.coalesce(column, f"{x}0") for x, column in here.items()}})
    accepted = is_page | (is_locus & (F.col("pages_") > 0))
    # Loci before the first header are not accepted and belong to no page.
    island = F.when(F.col("pages_") > 0, F.col("pages_") + F.col("loci_") - F.col("first_")).otherwise(0) - accepted.cast("int")
    return seen.select(*lines.columns, "kind", F.col("pages_").cast("long").alias("page_ord"), (F.col("loci_") - F.col("last_")).cast("int").alias("line_index"), accepted.alias("accepted"), island.cast("long").alias("island"), *(F.col(f"{name}_").alias(name) for name in page))


def strict_errors(lines: DataFrame) -> DataFrame:
    """``file, line_no, line, reason`` of lines of no known kind (``unknown``) and loci outside all pages (``no page``)."""
    marked = placed(lines)
    bad = marked.where((F.col("kind") == "other") | ((F.col("kind") == "locus") & (F.col("page_ord") == 0)))
    return bad.select("file", "line_no", "line", F.when(F.col("kind") == "other", "unknown").otherwise("no page").alias("reason"))


def check_strict(lines: DataFrame) -> None:
    """Raise on the first line that is none of the known kinds, or a locus outside all pages."""
    first = strict_errors(lines).orderBy("file", "line_no").first()
    if first:
        if first.reason == "unknown":
            raise MalformedLocusError(f"line {first.line_no} is of no known kind: {first.line[:80]!r}", first.line_no, first.line)
        raise MissingPageContextError(f"line {first.line_no} has a locus, but no page header stands before it", first.line_no, first.line)


def _with_comments(events: DataFrame, marked: DataFrame) -> DataFrame:
    said = marked.where("kind = 'comment'").select("file", "island", F.struct("line_no", strip(F.regexp_extract("line", COMMENT, 1)).alias("text")).alias("said"))
    said = said.groupBy("file", "island").agg(F.array_sort(F.collect_list("said")).alias("said"))
    joined = events.join(said, ["file", "island"], "left")
    return joined.withColumn("comments", F.coalesce(F.col("said.text"), F.array().cast("array<string>"))).drop("said", "island")


def _page_columns(line: str) -> dict[str, Column]:
    return {"page_id": F.regexp_extract(line, PAGE, 1), "variables": header_variables(F.col(line))}


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def pages(lines: DataFrame, comments: bool = True) -> DataFrame:
    """One row a page header: ``file, page_ord, line_no, page_id, variables`` and its comments."""
    marked = placed(lines)
    found = marked.where("kind = 'page'").select("file", "page_ord", "line_no", *_named(_page_columns("line")), "island")
    return _with_comments(found, marked) if comments else found.drop("island")


def _parts(line: str = "line") -> Column:
    """The seven parts of a locus' line, from one match; parts that it lacks are empty."""
    found = F.regexp_replace(line, f"{LOCUS}(?s:.*)", "\x01".join(f"${k}" for k in range(1, 8)))
    return F.split(found, "\x01", 7)


def _locus_columns() -> list[Column]:
    """A locus' columns; ``parts`` holds its parts."""
    part = lambda k: F.get("parts", F.lit(k - 1))
    return [
        part(1).alias("locus_page_id"),
        part(2).cast("int").alias("locus_number"),
        F.nullif(part(3), F.lit("")).alias("position"),
        part(4).alias("locus_type"),
        F.nullif(part(5), F.lit("")).cast("int").alias("subtype"),
        F.nullif(part(6), F.lit("")).alias("transcriber"),
        strip(part(7)).alias("text"),
        F.concat(F.substring_index("line", ">", 1), F.lit(">")).alias("raw_locator"),
        F.concat_ws(":", part(1), part(2).cast("int")).alias("locus_id"),
        F.col("line_index"),
    ]


def loci(lines: DataFrame, comments: bool = True, with_page: bool = False) -> DataFrame:
    """One row a locus below a header, with the header's page (``page_ord``).

    ``line_index`` counts a page's loci. The locus' own page id may differ from
    its page's; ``locus_id`` is made of its own. ``with_page`` adds the page's
    ``page_id`` and ``variables``, from the header that each line carries.
    """
    marked = placed(lines, with_page)
    here = marked.where("kind = 'locus' and page_ord > 0").withColumn("parts", _parts())
    found = here.select("file", "page_ord", "line_no", *_locus_columns(), *(["page_id", "variables"] if with_page else []), "island")
    return _with_comments(found, marked) if comments else found.drop("island")


def pages_with_counts(lines: DataFrame) -> DataFrame:
    """``file, page_ord, page_id, variables`` of every page, with what its loci sum up to, in one pass.

    ``n_loci`` are all loci, ``line_count`` and ``label_count`` those of
    paragraphs and labels; ``has_text`` tells whether any holds text.
    """
    marked = placed(lines).where("kind in ('page', 'locus') and page_ord > 0")
    marked = marked.withColumn("parts", F.when(F.col("kind") == "locus", _parts()))
    # Narrow rows to be grouped: a header has no parts, a locus' line is read already.
    marked = marked.select("file", "page_ord", "kind", F.when(F.col("kind") == "page", F.col("line")).alias("line"), F.get("parts", F.lit(3)).alias("letter"), (strip(F.get("parts", F.lit(6))) != "").alias("filled"))
    of_type = lambda letter: F.count_if(F.col("letter") == letter)
    text = F.col("filled")
    counted = marked.groupBy("file", "page_ord").agg(
        F.max("line").alias("head"), F.count_if(F.col("kind") == "locus").alias("n_loci"), of_type("P").alias("line_count"), of_type("L").alias("label_count"), F.coalesce(F.bool_or(text), F.lit(False)).alias("has_text")
    )
    return counted.select("file", "page_ord", *_named(_page_columns("head")), "n_loci", "line_count", "label_count", "has_text")


def formats(lines: DataFrame) -> DataFrame:
    """``file, format_version, format_options`` by the last format header of each file."""
    found = classify(lines).where("kind = 'format'")
    options = F.nullif(strip(F.regexp_extract("line", FORMAT, 2)), F.lit(""))
    last = F.max_by(F.struct(F.regexp_extract("line", FORMAT, 1).alias("format_version"), options.alias("format_options")), "line_no")
    return found.groupBy("file").agg(last.alias("last")).select("file", "last.*")


def shown(locus_id: Column, text: Column) -> Column:
    """A locus in short: its text cut at 30 characters."""
    return F.concat(F.lit("Locus("), locus_id, F.lit(": "), F.when(F.char_length(text) > 30, F.concat(F.left(text, F.lit(30)), F.lit("..."))).otherwise(text), F.lit(")"))


def locator_texts(lines: DataFrame) -> DataFrame:
    """Text after the first ``>`` of every line that begins like a locator, headers and odd loci too."""
    found = lines.where(F.col("line").startswith("<f") & F.col("line").contains(">"))
    return found.select("file", "line_no", strip(F.regexp_extract("line", r"^[^>]*>(.*)$", 1)).alias("text"))


class Transcription:
    """The lines of some files, read once for several tables."""

    def __init__(self, lines: DataFrame, strict: bool = False):
        if strict:
            check_strict(lines)
        self.lines = lines

    @property
    def pages(self) -> DataFrame:
        return pages(self.lines)

    @property
    def loci(self) -> DataFrame:
        return loci(self.lines)

    @property
    def formats(self) -> DataFrame:
        return formats(self.lines)


def read_ivtff(spark: SparkSession, paths: str | list[str], strict: bool = False) -> Transcription:
    return Transcription(read_lines(spark, paths), strict)


def parse_text(spark: SparkSession, content: str, name: str = "text", strict: bool = False) -> Transcription:
    return Transcription(lines_of(spark.createDataFrame([(name, content)], "file string, value string")), strict)
