"""Sources: paged text, layout geometry, JSON lines, triples, vocabularies, transcripts, word lists, binary pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestone.functions import text as tx
from lodestone import schemas

PAGE_MARK = r"^## p\. (\S+) \(#(\d+)\)"


def read_volumes(spark: SparkSession, path: str) -> DataFrame:
    """(volume, text): one row a file of form-feed separated pages."""
    return spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("volume"), F.col("value").alias("text"))


def page_mark(line: Column) -> tuple[Column, Column]:
    """Printed page (null where it is not a number) and image index of a page marker line."""
    return F.regexp_extract(line, PAGE_MARK, 1).try_cast("int"), F.regexp_extract(line, PAGE_MARK, 2).try_cast("int")


def page_chunks(volumes: DataFrame) -> DataFrame:
    """(volume, page_no, printed_page, img_idx, has_mark, lines): the pages of each volume, blank and annotation lines dropped."""
    pages = volumes.select("volume", F.posexplode(F.split("text", "\f")).alias("page_no", "chunk"))
    lines = F.split("chunk", r"\r?\n")
    mark = F.get(F.filter(lines, lambda x: x.rlike(PAGE_MARK)), F.lit(0))
    printed, index = page_mark(F.coalesce(mark, F.lit("")))
    body = F.filter(lines, lambda x: (F.trim(x) != "") & ~x.startswith("<!--") & ~x.rlike(PAGE_MARK))
    return pages.select(
        "volume", "page_no", printed.alias("printed_page"), index.alias("img_idx"), mark.isNotNull().alias("has_mark"), F.transform(body, F.rtrim).alias("lines"), "chunk"
    )


def merged_page_texts(volumes: DataFrame) -> DataFrame:
    """(volume, printed_page, idx, chunk) of pages that carry a marker; idx counts from 0."""
    return page_chunks(volumes).where("has_mark").select("volume", "printed_page", (F.col("img_idx") - 1).alias("idx"), "chunk")


def heal_wraps(lines: Column) -> Column:
    """Join lines broken at a hyphen: before a lower-case continuation, or inside an all-capital word."""
    caps_end = r"[A-ZÀ-Þ][A-ZÀ-Þ0-9'’.\-]*-\.?$"

    def add(done: Column, line: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joins = F.coalesce(last.rlike(r"[A-Za-zÀ-ÿ]-\.?$") & (line.rlike(r"^[a-zà-ÿ]") | last.rlike(caps_end)), F.lit(False))
        healed = F.concat(F.regexp_replace(last, r"-\.?$", ""), F.ltrim(line))
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(healed))).otherwise(F.concat(done, F.array(line)))

    return F.aggregate(lines, F.array().cast("array<string>"), add)


def body_lines(chunks: DataFrame, classifies) -> DataFrame:
    """(volume, page_no, printed_page, line_no, line): lines of each page healed, without stamps, page numbers and leading running heads.

    ``classifies`` is a column function: whether a line opens an entry (such a line is never a running head).
    """
    healed = chunks.withColumn("lines", heal_wraps(F.col("lines")))
    page = F.col("printed_page")

    def wanted(line: Column) -> Column:
        s = F.trim(line)
        number = F.when(s.rlike(r"^\d{1,4}$"), s.try_cast("int"))
        near = F.coalesce(F.abs(number - page) <= 1, F.lit(False))
        return ~s.rlike(tx.WATERMARK) & ~s.rlike(tx.COLOPHON) & ~near

    def is_head(line: Column) -> Column:
        s = F.trim(line)
        return s.rlike(r"^\d{1,4}$") | (s.rlike(r"^[A-ZÀ-Þ][A-ZÀ-Þ.'’\- ]{1,30}$") & ~classifies(line))

    kept = healed.withColumn("lines", F.filter("lines", wanted))
    heads = F.transform("lines", is_head)
    first = F.array_position(heads, F.lit(False))
    start = F.when(F.size("lines") == 0, 1).when(first == 0, F.size("lines") + 1).otherwise(first).cast("int")
    bare = kept.withColumn("first", start).withColumn("lines", F.when(F.col("first") > F.size("lines"), F.array().cast("array<string>")).otherwise(F.expr("slice(lines, first, size(lines) - first + 1)")))
    return bare.select("volume", "page_no", "printed_page", F.posexplode("lines").alias("line_no", "line"))


def merge_page_files(pages: DataFrame) -> DataFrame:
    """(volume, text, sha256): page texts (volume, stem, text) in numeric order of their stems, under a manifest line.

    Pages of a volume meet in one row, as the merged file holds them; a volume is bounded by its book.
    """
    order = F.struct(F.regexp_extract("stem", r"(\d+)", 1).cast("bigint").alias("n"), F.col("stem"), F.col("text"))
    grouped = pages.groupBy("volume").agg(F.sort_array(F.collect_list(order)).alias("p"), F.count_if(F.col("text").contains("<!-- plate")).alias("plates"), F.count("*").alias("n"))
    body = F.array_join(F.transform("p", lambda x: x["text"]), "\n\f\n")
    digest = F.sha2(body, 256)
    head = F.concat(F.lit("<!-- merged pages="), F.col("n").cast("string"), F.lit(" plates="), F.col("plates").cast("string"), F.lit(" src="), F.col("volume"), F.lit(" sha256="), F.substring(digest, 1, 16), F.lit(" -->\n"))
    return grouped.select("volume", F.concat(head, body).alias("text"), digest.alias("sha256"))


def stale_merges(merged: DataFrame, pages: DataFrame) -> DataFrame:
    """Volumes whose merged text no longer equals its pages; the manifest line does not count."""
    now = merge_page_files(pages).select("volume", F.col("sha256").alias("now"))
    old = merged.select("volume", F.sha2(F.regexp_replace("text", r"^<!-- merged [^\n]*-->\n", ""), 256).alias("old"))
    return old.join(now, "volume", "full").where(~F.col("old").eqNullSafe(F.col("now"))).select("volume")


def read_geometry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGE_GEOMETRY).json(path)


def read_page_images(spark: SparkSession, path: str) -> DataFrame:
    """Page images or documents as bytes, in name order within each task's files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content")


def scan_text_pages(pages: DataFrame, low_text: int = 120) -> tuple[DataFrame, DataFrame]:
    """From (volume, idx, printed_page, text): first index of each printed page, and the pages with little text."""
    index = pages.where(F.col("printed_page").isNotNull()).groupBy("volume", "printed_page").agg(F.min("idx").alias("idx"))
    return index, pages.where(F.length(F.trim("text")) < low_text).select("volume", "idx")


def read_shards(spark: SparkSession, path: str, schema: str = schemas.SHARD_LINE) -> DataFrame:
    """JSON lines of all shards with the file and position that order them; malformed lines are dropped.

    Position: ``monotonically_increasing_id`` follows file order inside a file.
    """
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return rows.withColumn("file", F.col("_metadata.file_path")).withColumn("line", F.monotonically_increasing_id())


def ingestable(shards: DataFrame, entries: DataFrame) -> DataFrame:
    """The last line of each known entry: unknown entries are skipped, later files and lines replace earlier ones."""
    last = Window.partitionBy("entry_id").orderBy(F.desc("file"), F.desc("line"))
    known = shards.join(entries.select("entry_id").distinct(), "entry_id", "left_semi")
    return known.withColumn("rn", F.row_number().over(last)).where("rn = 1").drop("rn")


def pending(work: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``work`` that no earlier run has done."""
    keys = [key] if isinstance(key, str) else key
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """(s, p, o) of an N-Triples file."""
    return parse_triples(spark.read.text(path).select(F.col("value").alias("line")))


def parse_triples(lines: DataFrame) -> DataFrame:
    pattern = r"^<([^>]*)>\s+<([^>]*)>\s+(.+?)\s*\.$"
    return lines.where(F.col("line").rlike(pattern)).select(*[F.regexp_extract("line", pattern, i).alias(n) for i, n in ((1, "s"), (2, "p"), (3, "o"))])


def preferred_labels(triples: DataFrame) -> DataFrame:
    """(concept, label): two hops, concept to English term, term to literal (English or without language)."""
    term = triples.where(F.col("p").endswith("prefLabel") & F.col("o").rlike("-en>$")).select(F.col("s").alias("concept"), F.regexp_extract("o", "<([^>]*)>", 1).alias("term"))
    literal = triples.where(F.col("p").endswith("literalForm") & F.col("o").rlike(r'^"[^"]*"(@en)?$')).select(F.col("s").alias("term"), F.regexp_extract("o", '^"([^"]*)"', 1).alias("label"))
    return term.join(literal, "term").select("concept", "label")


def broader_edges(triples: DataFrame) -> DataFrame:
    kind = F.col("p").endswith("broaderPreferred") | F.col("p").endswith("broaderGeneric")
    return triples.where(kind).select(F.col("s").alias("concept"), F.regexp_extract("o", "<([^>]*)>", 1).alias("broader"))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(type_id, label, fclass, terms) of a concept list {"concepts": [...]}."""
    concept = "struct<aat_id:string,label:string,fclass:string,gazetteer_terms:array<string>,uri:string>"
    rows = spark.read.schema(f"concepts array<{concept}>").option("multiLine", True).json(path)
    return rows.select(F.explode("concepts").alias("c")).select(F.col("c.aat_id").alias("type_id"), "c.label", "c.fclass", F.col("c.gazetteer_terms").alias("terms"))


def transcript_headwords(pages: DataFrame, html: str = "html") -> DataFrame:
    """Distinct keys of the all-capital names that open paragraphs of an HTML transcript."""
    pattern = r"<p>\s*([A-ZÀ-Þ][A-ZÀ-Þ0-9'’ .&\-]{1,60}?(?: \([^)]*\))?)\s*[,.]"
    found = pages.select(F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))).alias("name"))
    return found.select(tx.alpha_key(F.col("name")).alias("key")).where(F.length("key") >= 3).distinct()


def read_words(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).where("word <> ''").distinct()


def marker_boxes(chunk: Column) -> Column:
    """Boxes of all table markers of a page; malformed ones are dropped."""
    raw = F.regexp_extract_all(chunk, F.lit(r"<!-- table bbox=(\[[^\]]*\])"), F.lit(1))
    parsed = F.transform(raw, lambda x: F.from_json(x, T.ArrayType(T.DoubleType())))
    return F.filter(parsed, lambda b: b.isNotNull() & (F.size(b) == 4) & ~F.exists(b, lambda v: v.isNull()))


def running_heads(lines: Column, stop: list[str] | None = None) -> Column:
    """All-capital lines of three letters or more that are neither Roman numbers nor on the stop list."""
    stop = stop or tx.TABLE_WORDS
    ok = lambda s: s.rlike(r"^[A-ZÀ-Þ][A-ZÀ-Þ .'’\-]*$") & (F.length(tx.alpha_key(s)) >= 3) & ~tx.alpha_key(s).rlike("^[IVXLCDM]+$") & ~s.isin(stop)
    return F.filter(F.transform(lines, lambda s: F.trim(s)), ok)


def printed_page_guess(text: Column) -> Column:
    """Page marker within the first 200 characters, else a bare number of 1 to 999 in the first six lines with text."""
    mark = F.regexp_extract(F.substring(text, 1, 200), r"## p\. (\d+)", 1).try_cast("int")
    lines = F.slice(F.filter(F.transform(F.split(text, "\n"), lambda s: F.trim(s)), lambda s: s != ""), 1, 6)
    bare = F.get(F.filter(lines, lambda s: s.rlike(r"^\d{1,3}$") & ~s.rlike("^0+$")), F.lit(0)).try_cast("int")
    return F.coalesce(mark, bare)


def orientation_issues(issues: DataFrame) -> DataFrame:
    """(plate, degrees) that reports of an issue tracker (title, body) ask for: the plate from the title or body, a turn of 90, 180 or 270."""
    text = F.concat_ws("\n", "title", "body")
    plate = F.nullif(F.regexp_extract(text, r"(?i)plate[:\s#]+([\w\-]+)", 1), F.lit(""))
    degrees = F.regexp_extract(text, r"(?i)(?:rotate|turn)\D{0,20}(90|180|270)", 1).try_cast("int")
    return issues.select(plate.alias("plate"), degrees.alias("degrees")).where("plate IS NOT NULL AND degrees IS NOT NULL")
