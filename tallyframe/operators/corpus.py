"""Document corpus: folder index, title and blurb extraction, block replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.text import (
    INLINE_WHITESPACE, LINE_BREAKS, char_class, regex_literal, replacement_literal, url_quote, ustrip,
)
from tallyframe.operators.numbering import rank_text
from tallyframe.session import shared_table

# Folder names never indexed, the block markers, the
# placeholder blurb and the prefixes that disqualify a line as a blurb.
IGNORE = [".git", ".github", "scripts", ".venv", "__pycache__", ".mypy_cache", ".pytest_cache"]
START, END = "<!-- PROJECTS:START -->", "<!-- PROJECTS:END -->"
PLACEHOLDER = "_add a README to this folder_"
SKIP_PREFIXES = ["#", "!", "<", "[!", ">", "-", "|", "`"]
TABLE_HEADER = "| Project | What it covers |\n| --- | --- |"

# First "# heading" line.  Java flags: m = multi-line, d = only \n ends a
# line (Python's rule), U = Unicode \s.
TITLE_PATTERN = r"(?mdU)^#\s+(.+)$"


def visible(name: Column | str = "name") -> Column:
    """Not hidden and not on the ignore list."""
    n = F.col(name) if isinstance(name, str) else name
    return ~n.isin(IGNORE) & ~n.startswith(".")


def title_of(text: Column | str = "text", name: Column | str = "name") -> Column:
    """Stripped first heading; the folder name when there is no heading or no text."""
    t = F.col(text) if isinstance(text, str) else text
    n = F.col(name) if isinstance(name, str) else name
    return F.when(t.rlike(TITLE_PATTERN), ustrip(F.regexp_extract(t, TITLE_PATTERN, 1))).otherwise(n)


# Python line breaks that Java's multi-line ^, $ and . do not know.
_RARE_BREAKS = "\u000b\u000c\u001c\u001d\u001e"


def _blurb_patterns() -> tuple[str, str]:
    # The first line (lines end at any str.splitlines() boundary) that,
    # stripped, is non-empty and starts with none of SKIP_PREFIXES; group 1
    # is that line up to its end (trailing space is stripped afterwards, which
    # is cheaper than a lazy match).  Built from the fixed prefix list.  The fast
    # form relies on Java's multi-line anchors (\n, \r\n, \r, \x85, \u2028,
    # \u2029); the full form also ends lines at the rare breaks.
    ws = char_class(INLINE_WHITESPACE)
    br = char_class(LINE_BREAKS)
    singles = "".join("\\" + p if p in "-[]\\^" else p for p in SKIP_PREFIXES if len(p) == 1)
    two = [p for p in SKIP_PREFIXES if len(p) == 2]
    assert all(p[0] == "[" for p in two)
    not_two = "".join(f"(?!{regex_literal(p[1:])})" for p in two)
    first = f"(?:[^{ws}{br}{singles}\\[]|\\[{not_two})"
    fast = f"(?m)^[{ws}]*({first}.*)"
    full = f"(?:\\A|(?<=[{br}]))[{ws}]*({first}[^{br}]*)"
    return fast, full


BLURB_FAST, BLURB_FULL = _blurb_patterns()


def blurb_of(text: Column | str = "text") -> Column:
    """First stripped, non-empty line that is not a heading, image, tag,
    badge, quote, list item, table row or code fence; ``''`` if none.

    One regex over the whole text: the scan stops at the first qualifying
    line and neither a per-line array nor a rewritten copy is built.
    """
    t = F.col(text) if isinstance(text, str) else text
    rare = t.rlike(f"[{char_class(_RARE_BREAKS)}]")
    found = F.when(rare, F.regexp_extract(t, BLURB_FULL, 1)).otherwise(F.regexp_extract(t, BLURB_FAST, 1))
    return F.coalesce(ustrip(found), F.lit(""))


def index(docs: DataFrame, name: str = "name", text: str = "text") -> DataFrame:
    """``name, title, blurb, pos`` for every visible folder; ``pos`` is its place in name order."""
    rows = docs.where(visible(name)).select(
        F.col(name).alias("name"), title_of(text, name).alias("title"), blurb_of(text).alias("blurb"))
    return rank_text(shared_table(rows, "index"), "name", "pos")


def index_table(rows: DataFrame) -> DataFrame:
    """``pos, line`` of the whole marked block: its markers, the header, a row per folder in name order."""
    header = [F.struct(F.lit(i - 2).cast("bigint").alias("pos"), F.lit(line).alias("line")) for i, line in enumerate(TABLE_HEADER.split("\n"))]
    head = rows.sparkSession.range(1).select(F.inline(F.array(*header)))
    ends = [F.struct(F.lit(p).cast("bigint").alias("pos"), F.lit(line).alias("line")) for p, line in ((-4, START), (-3, ""))]
    last = rows.agg(F.coalesce(F.max("pos"), F.lit(-1)).alias("last")).select(F.inline(F.array(
        F.struct((F.col("last") + 1).alias("pos"), F.lit("").alias("line")), F.struct((F.col("last") + 2).alias("pos"), F.lit(END).alias("line")))))
    begin = rows.sparkSession.range(1).select(F.inline(F.array(*ends)))
    return begin.unionAll(head).unionAll(rows.select("pos", index_row().alias("line"))).unionAll(last)


def index_row(title: Column | str = "title", name: Column | str = "name",
              blurb: Column | str = "blurb") -> Column:
    """``| [title](./quoted-name) | blurb |`` with the placeholder for no blurb."""
    t = F.col(title) if isinstance(title, str) else title
    n = F.col(name) if isinstance(name, str) else name
    b = F.col(blurb) if isinstance(blurb, str) else blurb
    shown = F.when(F.coalesce(b, F.lit("")) == "", F.lit(PLACEHOLDER)).otherwise(b)
    return F.concat(F.lit("| ["), t, F.lit("](./"), url_quote(n), F.lit(") | "), shown, F.lit(" |"))


def block_pattern(start: str = START, end: str = END) -> str:
    return "(?s)" + regex_literal(start) + ".*?" + regex_literal(end)


def replace_block(df: DataFrame, text: str, block: Column, start: str = START,
                  end: str = END) -> DataFrame:
    """Replace every marked block with ``block`` inserted literally.

    Adds ``new_text``, ``changed`` and ``error`` (markers absent: the text is
    left as it is and the row says why).
    """
    pat = block_pattern(start, end)
    t = F.col(text)
    # the replaced text is computed once; the outputs refer to it
    staged = df.withColumns({"__has": t.rlike(pat),
                             "__new": F.regexp_replace(t, F.lit(pat), replacement_literal(block))})
    has, new = F.col("__has"), F.col("__new")
    return staged.withColumns({
        "new_text": F.when(has, new).otherwise(t),
        "changed": has & (new != t),
        "error": F.when(~has, F.lit(f"Markers not found. Add {start} and {end} to README.md.")),
    }).drop("__has", "__new")


def marked_block(rows: Column, start: str = START, end: str = END) -> Column:
    """The text that goes between the markers: header plus index rows."""
    return F.concat(F.lit(f"{start}\n\n{TABLE_HEADER}\n"), rows, F.lit(f"\n\n{end}"))


def read_folders(spark: SparkSession, root: str) -> DataFrame:
    """Top-level folders of ``root`` with their ``README.md`` text (null when
    absent).  Listing and reading are Spark file scans; a folder is seen when
    it holds at least one file.  Spark's listing already skips names starting
    with ``.`` or ``_``."""
    root = root.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select(F.col("path")))
    # both columns in the plain form: ``path`` is decoded, ``_metadata.file_path`` is not
    rel = F.regexp_extract("path", r"^.*?" + regex_literal(root.split(":", 1)[-1]) + r"/([^/]+)/", 1)
    folders = files.select(rel.alias("name")).where(F.col("name") != "").distinct()
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    readmes = (spark.read.text(f"{root}/*/README.md", wholetext=True)
               .select(F.regexp_extract(plain, r"/([^/]+)/README\.md$", 1).alias("name"), F.col("value").alias("text")))
    return folders.join(readmes, "name", "left")
