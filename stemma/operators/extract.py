"""Candidates from texts, files, paths and payloads: table-generating operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import rules as R
from ..functions.text import html_text, let, list_items, list_value, noise_title, normalized_title, public_reason, safe, stem, title_from_command, title_from_parts, title_fragment
from .dedupe import distinct_first

CANDIDATE = ["source_kind", "source_path", "candidate_title", "normalized_title", "confidence", "content_kind"]
#: Kinds of source whose first line may be a title by itself.
LINE_KINDS = ["archiveorg-title", "archiveorg-note", "redump-snippet", "redump-title"]


def candidates(df: DataFrame, title: str, keep: list[str]) -> DataFrame:
    """Rows with a candidate's columns; titles that name nothing are dropped."""
    out = df.withColumn("candidate_title", title_fragment(F.col(title))).withColumn("normalized_title", normalized_title(F.col("candidate_title")))
    return out.where(~noise_title(F.col("normalized_title"))).select(*keep, *CANDIDATE)


def lines(df: DataFrame, keys: list[str], text: Column) -> DataFrame:
    return df.select(*keys, F.posexplode(F.split(text, r"\r\n|[\n\r\x0B\f]")).alias("line_no", "raw")).withColumn("line", F.trim(F.regexp_replace("raw", r"^\s+|\s+$", "")))


def sections(df: DataFrame, keys: list[str], text: str, html: bool = True) -> DataFrame:
    """Every line of every text with its section: marker (the line opens one), header (with a list after a colon),
    in_section, kind (of the section the line stands in). A blank line ends a section."""
    ln = lines(df, keys, html_text(F.col(text)) if html else F.col(text))
    ln = ln.withColumn("blank", F.col("line") == "").withColumn("marker", ~F.col("blank") & R.has_marker(F.col("line")))
    ln = ln.withColumn("header", F.col("marker") & F.col("line").contains(":"))
    own = F.when(F.col("header"), R.content_kind(F.split_part("line", F.lit(":"), F.lit(1)))).when(F.col("marker"), R.content_kind(F.col("line")))
    w = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    ln = ln.withColumn("own", own).withColumn("block", F.sum(F.col("blank").cast("int")).over(w))
    b = Window.partitionBy(*keys, "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    ln = ln.withColumn("kind", F.coalesce(F.last("own", ignorenulls=True).over(b), F.lit("unknown")))
    return ln.withColumn("in_section", ~F.col("blank") & F.last("own", ignorenulls=True).over(b).isNotNull()).drop("own", "block")


def text_candidates(df: DataFrame, keys: list[str], text: str, html: bool = True) -> DataFrame:
    """Candidates of texts (columns source_kind, source_path, confidence beside the text), in order of first occurrence, and
    structured: whether the text has lists under section words."""
    meta = ["source_kind", "source_path", "confidence"]
    ln = sections(df, [*keys, *meta], text, html)
    listed = F.col("in_section") & ~F.col("marker") & (F.col("line").rlike(r"^[-*•]") | (F.size(F.split("line", r"\s+")) <= 8))
    tail = F.regexp_replace("line", "^[^:]*:", "")
    items = F.when(F.col("header"), list_items(tail)).when(listed, list_items(F.col("line"))).otherwise(F.array().cast("array<string>"))
    ln = ln.withColumns({"listed": listed, "items": items}).withColumn("says", F.when(F.col("header"), F.size("items") > 0).otherwise(F.col("marker") | F.col("listed")))
    structured = ln.groupBy(*keys, *meta).agg(F.max("says").alias("structured"))
    alone = ~F.col("blank") & ~F.col("marker") & ~F.col("listed") & F.col("source_kind").isin(LINE_KINDS)
    found = ln.select(*keys, *meta, "line_no", F.col("kind").alias("content_kind"), alone.alias("alone"), F.posexplode(F.when(alone, F.array("line")).otherwise(F.col("items"))).alias("item_no", "item"))
    got = candidates(found, "item", [*keys, "line_no", "item_no", "alone"])
    w = Window.partitionBy(*keys, "source_kind", "source_path")
    # A line by itself counts only as the very first candidate of its text.
    got = got.withColumn("__first", F.min(F.struct("line_no", "item_no")).over(w)).where(~F.col("alone") | (F.struct("line_no", "item_no") == F.col("__first")))
    got = distinct_first(got, [*keys, "source_kind", "source_path", "normalized_title"], [F.asc("line_no"), F.asc("item_no")])
    return got.drop("__first", "alone").join(structured.drop("confidence"), [*keys, "source_kind", "source_path"])


def key_values(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """key (lower case) and value of every line that has both, split at its first equals sign."""
    ln = lines(df, keys, F.col(text)).where(F.col("line").contains("="))
    out = ln.select(*keys, "line_no", F.lower(F.trim(F.split_part("line", F.lit("="), F.lit(1)))).alias("key"), F.trim(F.regexp_replace("line", "^[^=]*=", "")).alias("value"))
    return out.where("value <> ''")


def metadata_candidates(files: DataFrame, keys: list[str], prefix: str = "disc") -> DataFrame:
    """Candidates of metadata files (columns path, text)."""
    kv = key_values(files, [*keys, "path"], "text")
    value, command = F.col("key").isin("label", "title", "caption", "name"), F.col("key").isin("open", "icon", "exe", "run", "shell\\open\\command")
    kv = kv.where(value | command).select(
        *keys, "line_no", F.col("path").alias("source_path"), F.when(value, f"{prefix}-metadata-value").otherwise(f"{prefix}-metadata-command").alias("source_kind"),
        F.when(value, "high").otherwise("medium").alias("confidence"), R.content_kind(F.col("value")).alias("content_kind"),
        F.when(value, F.col("value")).otherwise(title_from_command(F.col("value"))).alias("title"),
    )
    got = candidates(kv.where("title is not null"), "title", [*keys, "line_no"])
    return distinct_first(got, [*keys, "source_kind", "source_path", "normalized_title"], [F.asc("line_no")]).drop("line_no")


def folders(path: Column) -> Column:
    return F.filter(F.slice(F.split(path, "/"), F.lit(1), F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0))), lambda p: p != "")


def exe_candidates(files: DataFrame, keys: list[str], prefix: str = "disc") -> DataFrame:
    """Two candidates of an executable's path (column path): the folder's title, then the file's if it says another."""
    both = F.array(
        F.struct(F.lit(0).alias("n"), F.lit(f"{prefix}-exe-parent").alias("source_kind"), F.lit("high").alias("confidence"), title_from_parts(folders(F.col("path"))).alias("title")),
        F.struct(F.lit(1).alias("n"), F.lit(f"{prefix}-exe-name").alias("source_kind"), F.lit("medium").alias("confidence"), title_fragment(stem(F.col("path"))).alias("title")),
    )
    rows = files.select(*keys, F.col("path").alias("source_path"), R.content_kind(F.col("path")).alias("content_kind"), F.inline(both)).where("title is not null")
    got = candidates(rows, "title", [*keys, "n"])
    return distinct_first(got, [*keys, "source_path", "normalized_title"], [F.asc("n")]).drop("n")


def path_candidates(files: DataFrame, keys: list[str], prefix: str, confidence: str) -> DataFrame:
    rows = files.select(*keys, F.col("path").alias("source_path"), F.lit(f"{prefix}-manifest-path").alias("source_kind"), F.lit(confidence).alias("confidence"), R.content_kind(F.col("path")).alias("content_kind"), title_from_parts(F.split("path", "/")).alias("title"))
    return candidates(rows.where("title is not null"), "title", keys)


def subject_candidates(items: DataFrame, keys: list[str], subjects: Column) -> DataFrame:
    """Candidates of a list of subjects (keys, identifier); structured from two on."""
    rows = items.select(*keys, F.concat("identifier", F.lit(":subject")).alias("source_path"), F.lit("archiveorg-subject").alias("source_kind"), F.lit("medium").alias("confidence"), F.lit("unknown").alias("content_kind"), F.posexplode(subjects).alias("n", "title"))
    got = distinct_first(candidates(rows, "title", [*keys, "n"]), [*keys, "source_path", "normalized_title"], [F.asc("n")])
    return got.withColumn("structured", F.count("*").over(Window.partitionBy(*keys, "source_path")) >= 2).drop("n")


def payload_candidates(items: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates of an item's metadata (identifier, JSON payload): subjects and topics, description, notes, title; every
    value of a field is a text of its own."""
    names = ("subject", "topics", "description", "notes", "note", "title")
    p = items.withColumns({f: F.coalesce(list_value(F.get_json_object("payload", f"$.metadata.{f}")), F.array().cast("array<string>")) for f in names})
    subject = subject_candidates(p, keys, F.concat("subject", "topics"))
    kinds = (("description", "archiveorg-description", "high"), ("notes", "archiveorg-note", "medium"), ("note", "archiveorg-note", "medium"), ("title", "archiveorg-title", "low"))
    fields = F.array(*[F.struct(F.lit(k).alias("source_kind"), F.lit(c).alias("confidence"), F.lit(f).alias("field"), F.col(f).alias("values")) for f, k, c in kinds])
    texts = p.select(*keys, "identifier", F.posexplode(fields).alias("field_no", "f")).select(*keys, "field_no", "f.source_kind", "f.confidence", F.concat("identifier", F.lit(":"), "f.field").alias("source_path"), F.posexplode("f.values").alias("value_no", "text"))
    rest = text_candidates(texts, [*keys, "field_no", "value_no"], "text")
    rest = distinct_first(rest, [*keys, "source_kind", "source_path", "normalized_title"], [F.asc(c) for c in ("field_no", "value_no", "line_no", "item_no")])
    return subject.unionByName(rest.drop("field_no", "value_no", "line_no", "item_no"))


def captured_links(df: DataFrame, keys: list[str], html: str, block: str = r"(?is)<ul[^>]*>(.*?)</ul>") -> DataFrame:
    """Address and text of every link inside the first block of a page."""
    inner = F.regexp_extract(html, block, 1)
    anchors = F.regexp_extract_all(inner, F.lit(r'(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>'), F.lit(0))
    out = df.select(*keys, F.posexplode(anchors).alias("n", "a"))
    return out.select(*keys, "n", F.regexp_extract("a", r'(?is)href="([^"]*)"', 1).alias("href"), F.trim(F.regexp_replace(F.regexp_replace("a", "<[^>]+>", " "), r"\s+", " ")).alias("label"))


def phrase_candidates(pages: DataFrame, keys: list[str], html: str, phrase: str, kind: str, path: str) -> DataFrame:
    """Candidates of a result page: what follows a phrase on the lines that hold it."""
    ln = lines(pages, keys, html_text(F.col(html))).where(F.col("line").contains(phrase))
    rest = F.btrim(F.substring("line", F.locate(phrase, F.col("line")) + len(phrase), F.length("line")), F.lit(" :-"))
    rows = ln.withColumn("title", rest).where("title <> ''").select(*keys, "line_no", "title", F.lit(kind).alias("source_kind"), F.lit(path).alias("source_path"), F.lit("low").alias("confidence"), R.content_kind(F.col("title")).alias("content_kind"))
    return distinct_first(candidates(rows, "title", [*keys, "line_no"]), [*keys, "normalized_title"], [F.asc("line_no")]).drop("line_no")


def table_candidates(pages: DataFrame, keys: list[str], html: str, caption: str, link: str, kind: str) -> DataFrame:
    """Candidates of an issue page (source_path): the linked titles in the table under a caption."""
    inner = F.regexp_extract(html, rf"(?is){caption}</p>\s*<table[^>]*>(.*?)</table>", 1)
    titles = F.regexp_extract_all(inner, F.lit(rf'(?is)<td>\s*<a[^>]+{link}[^"]+"[^>]*>([^<]+)</a>'), F.lit(1))
    rows = pages.select(*keys, "source_path", F.posexplode(titles).alias("n", "raw")).withColumn("title", html_text(F.col("raw")))
    rows = rows.select(*keys, "source_path", "n", "title", F.lit(kind).alias("source_kind"), F.lit("high").alias("confidence"), F.lit("full_version").alias("content_kind"))
    return distinct_first(candidates(rows, "title", [*keys, "n"]), [*keys, "source_path", "normalized_title"], [F.asc("n")]).drop("n")


def metadata_files(files: DataFrame, depth: int = 3, most: int = 128 * 1024) -> DataFrame:
    """Of a manifest (path, length, is_link) the small files that may hold titles, no deeper than so many parts."""
    ok = suffix(F.col("path")).isin(V.METADATA_SUFFIXES) & (F.col("length") <= most) & (F.size(F.split("path", "/")) <= depth) & ~F.coalesce("is_link", F.lit(False))
    return files.where(ok)


def merged_hits(hits: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first n different ids of ordered searches (query_no, place)."""
    from .dedupe import best_by

    return best_by(distinct_first(hits, [*keys, "id"], [F.asc("query_no"), F.asc("place")]), keys, [F.asc("query_no"), F.asc("place")], n)


def issue_queries(code: Column, year: Column, variant: Column, name: str) -> Column:
    """The search phrases for an issue of a magazine, in order, each once."""
    month, short = F.substring(code, 4, 2), F.lpad((year % 100).cast("string"), 2, "0")
    quoted = lambda *x: F.concat(F.lit(f'"{name}"'), *[F.concat(F.lit(' "'), v, F.lit('"')) for v in x])
    date = F.concat(month, F.lit("/"), short)
    more = F.when(~variant.isin("CD", "Standard"), quoted(date, variant))
    return F.array_distinct(F.filter(F.array(quoted(code), quoted(F.concat(month, F.lit("/"), year.cast("string"))), quoted(date), more), lambda x: x.isNotNull()))


def alias_pairs(df: DataFrame, keys: list[str]) -> DataFrame:
    """Different (normalized, title) pairs of a group's issue rows, in order: the row's own, then its variants if both lists
    are as long. Needs source_title, source_normalized_title, observed_title_variants, source_normalized_variants, ordinal."""
    parts = lambda c: F.filter(F.transform(F.split(safe(F.col(c)), ";"), lambda x: F.trim(x)), lambda x: x != "")
    pair = lambda a, b: F.struct(a.alias("normalized"), b.alias("title"))
    own = F.array(pair(safe(F.col("source_normalized_title")), safe(F.col("source_title"))))
    zipped = F.zip_with(parts("source_normalized_variants"), parts("observed_title_variants"), pair)
    more = F.when(F.size(parts("source_normalized_variants")) == F.size(parts("observed_title_variants")), zipped).otherwise(F.slice(own, 1, 0))
    rows = df.select(*keys, "ordinal", F.posexplode(F.concat(own, more)).alias("n", "p")).select(*keys, "ordinal", "n", "p.*").where("normalized <> '' or title <> ''")
    return distinct_first(rows, [*keys, "normalized", "title"], [F.asc("ordinal"), F.asc("n")])


def preferred_link(links: Column) -> Column:
    """Struct (site, title) from a map of site to title: English, German, then the first other wiki; null without one."""
    others = F.array_sort(F.filter(F.map_keys(links), lambda k: k.endswith("wiki") & ~k.isin("enwiki", "dewiki", "commonswiki", "specieswiki", "wikidatawiki")))
    site = F.coalesce(*[F.when(F.map_contains_key(links, s), F.lit(s)) for s in ("enwiki", "dewiki")], F.get(others, 0))
    return let(site, lambda s: F.when(s.isNotNull(), F.struct(s.alias("site"), F.try_element_at(links, s).alias("title"))))


def archive_records(listing: DataFrame) -> DataFrame:
    """Records of a JSON listing (column listing: {"files": [{name, size}]}): archives one folder deep, names that parse."""
    from ..functions.text import archive_name

    files = listing.select("archive_item", F.inline(F.from_json("listing", "struct<files: array<struct<name: string, size: string>>>")["files"]))
    ok = F.lower("name").endswith(".7z") & ~F.col("name").contains("/Scans/") & (F.size(F.split("name", "/")) == 2)
    out = files.where(ok).withColumn("p", archive_name(F.col("name"))).where("p is not null")
    return out.select("archive_item", F.col("name").alias("archive_name"), F.col("size").try_cast("bigint").alias("size_bytes"), F.col("p.year").alias("year"), F.col("p.code").alias("issue_code"), F.col("p.variant").alias("variant"))


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))


def containers(manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Disc images to open (columns path, text of cue sheets or null): sheets and descriptors first, which take the files
    they name or share a name with, then single images that nothing took."""
    m = manifest.withColumn("suffix", suffix(F.col("path"))).withColumn("stem", F.regexp_replace("path", r"\.[^./]*$", "")).withColumn("folder", F.regexp_replace("path", "[^/]*$", ""))
    first = m.where(F.col("suffix").isin(".cue", ".mds", ".ccd"))
    named = first.where("suffix = '.cue'").select(*keys, F.explode(F.transform(F.regexp_extract_all("text", F.lit(r'(?im)^\s*FILE\s+"([^"]+)"'), F.lit(1)), lambda n: F.concat("folder", n))).alias("path"))
    taken = named.unionByName(m.join(first.select(*keys, "stem").distinct(), [*keys, "stem"], "left_semi").select(*keys, "path"))
    rest = m.where(F.col("suffix").isin(V.IMAGE_SUFFIXES)).join(taken.distinct(), [*keys, "path"], "left_anti")
    return first.select(*keys, "path").unionByName(rest.select(*keys, "path"))


def cue_tracks(sheets: DataFrame, keys: list[str]) -> DataFrame:
    """Per sheet (column text) its first data track: file, mode, first sector and the next track's first, if in the file."""
    ln = lines(sheets, keys, F.col("text"))
    sector = lambda c: F.regexp_extract(c, r"(\d+):(\d+):(\d+)", 1).try_cast("int") * 4500 + F.regexp_extract(c, r"(\d+):(\d+):(\d+)", 2).try_cast("int") * 75 + F.regexp_extract(c, r"(\d+):(\d+):(\d+)", 3).try_cast("int")
    w = Window.partitionBy(*keys).orderBy("line_no")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    found = lambda p, g: F.when(F.col("line").rlike(p), F.regexp_extract("line", p, g))
    ln = ln.withColumns({"file": F.last(found(r'(?i)^FILE\s+"?([^"]+?)"?\s+\w+$', 1), ignorenulls=True).over(upto), "track": F.last(found(r"(?i)^TRACK\s+(\d+)\s+(\S+)", 1), ignorenulls=True).over(upto), "mode": F.last(found(r"(?i)^TRACK\s+(\d+)\s+(\S+)", 2), ignorenulls=True).over(upto)})
    at = ln.where(F.col("line").rlike(r"(?i)^INDEX\s+01\s+\d")).withColumn("start", sector(F.col("line")))
    at = at.withColumns({"next_file": F.lead("file").over(w), "next_start": F.lead("start").over(w)}).withColumn("end", F.when(F.col("next_file") == F.col("file"), F.col("next_start")))
    return distinct_first(at.where(F.upper("mode") != "AUDIO"), keys, [F.asc("line_no")]).select(*keys, "file", "track", "mode", "start", "end")


def sector_payload(content: Column, first: Column, count: Column, size: int = 2352, offset: int = 16, payload: int = 2048) -> Column:
    """The data of so many sectors of a raw image, without their headers and checks."""
    # substring of binary is native; the pieces are joined as binary.
    parts = F.transform(F.sequence(first, first + count - 1), lambda s: F.hex(F.substring(content, (s * size + offset + 1).cast("int"), F.lit(payload))))
    return F.unhex(F.array_join(parts, ""))


def inventory(files: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of executables from files read as binary (path, length, content or null with error): size, digest, status."""
    exe = files.where(F.lower("path").endswith(".exe"))
    return exe.select(*keys, F.col("path").alias("exe_path"), F.element_at(F.split("path", "/"), -1).alias("exe_name"), F.when(F.col("content").isNotNull(), F.col("length")).alias("size_bytes"), F.sha1("content").alias("sha1"), F.when(F.col("content").isNull(), "hash_failed").otherwise("ok").alias("status"), public_reason(F.col("error")).alias("error"))


def text_sidecars(files: DataFrame, keys: list[str], n: int = 2) -> DataFrame:
    """The n smallest text files that may hold a scan's text (columns name, size)."""
    from .dedupe import best_by

    ocr = F.lower("name").rlike(r"(djvu|ocr|text)\.txt$")
    ok = F.lower("name").endswith(".txt") & (F.col("size") > 0) & (F.col("size") <= 5 * 1024 * 1024) & (ocr | (F.col("size") < 512 * 1024))
    return best_by(files.where(ok), keys, [F.asc("size"), F.asc(F.lower("name"))], n)


def image_paths(chosen: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """The file to read for each container (column path) and how: a sheet's converted image, a descriptor's data file if the
    manifest has it, else the container itself."""
    stem_ = F.regexp_replace("path", r"\.[^./]*$", "")
    data = F.when(suffix(F.col("path")) == ".mds", F.concat(stem_, F.lit(".mdf"))).when(suffix(F.col("path")) == ".ccd", F.concat(stem_, F.lit(".img")))
    have = manifest.select(*keys, F.col("path").alias("data_path")).distinct().withColumn("there", F.lit(True))
    out = chosen.withColumn("data_path", data).join(have, [*keys, "data_path"], "left")
    sheet = suffix(F.col("path")) == ".cue"
    how = F.when(sheet, "sheet to image").when(F.col("there"), "data file").otherwise("as it is")
    image = F.when(sheet, F.concat(stem_, F.lit(".iso"))).when(F.col("there"), F.col("data_path")).otherwise(F.col("path"))
    return out.select(*keys, "path", image.alias("image_path"), how.alias("how"))


def issue_page(code: Column, year: Column, base: str, first: int = 1999, last: int = 2004) -> Column:
    """Address of an issue's page, for the years that have one."""
    return F.when((year >= first) & (year <= last), F.concat(F.lit(base), F.substring(code, 4, 2), F.lit("-"), year.cast("string"), F.lit(".html")))


def activity(files: DataFrame) -> DataFrame:
    """One row: how many files and bytes a manifest (path, length) holds."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
