"""Cross-site boilerplate lines by the spread of sites that show them.

Lines are compared by 128 bits of hash. A cheap count drops lines that occur too seldom to be
spread or on one site only; of the others HyperLogLog sketches of the sites, merged by
aggregation, estimate the spread. Lines whose estimate is near the threshold are counted exactly.
The places of lines that pass the cheap count are written once, so the texts are split twice and no more.
A line that a third of all rows show is aggregated where it is read; where places meet the few lines
that remain, these are broadcast if they are few and the join is salted otherwise. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import WHITESPACE, join_small, let, write_table

MIN_SITES = 10
SKETCH_BITS = 12
#: Share of the threshold within which the estimate isn't trusted: six standard errors of a sketch of 12 bits.
BAND = 0.1
_ROW = ("_r", "_s")
_LINE = ["_a", "_b"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def occurrences(docs: DataFrame, id_col: str, site_col: str, text_col: str) -> DataFrame:
    """Every line with a visible character: its row's key, id and site, its place, its hash _a, _b."""
    lines = docs.select(*_ROW, F.col(id_col).alias("_id"), F.col(site_col).cast("string").alias("_site"), F.posexplode(_lines(F.col(text_col))).alias("_at", "_line"))
    trimmed = F.btrim("_line", F.lit(WHITESPACE))
    return lines.filter(trimmed != "").select(
        *_ROW, "_id", "_at", "_site", F.xxhash64(trimmed).alias("_a"), F.xxhash64(F.lit(1), trimmed).alias("_b")
    )


def frequent(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The lines that occur often enough, and on two sites at least, to be spread over min_sites."""
    often = (
        lines.groupBy(*_LINE)
        .agg(F.count("_site").alias("n"), F.min("_site").alias("low"), F.max("_site").alias("high"))
        .filter((F.col("n") >= min_sites) & ((F.col("low") < F.col("high")) | F.lit(min_sites < 2)))
        .select(*_LINE)
    )
    return write_table(join_small(lines, write_table(often, "often"), _LINE, "left_semi"), "places")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, band: float = BAND) -> DataFrame:
    """(_a, _b, first) of the lines that at least min_sites sites show; first: where they occur first."""
    place = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_r").alias("r"), F.col("_s").alias("s"), F.col("_at").alias("at"))
    spread = write_table(
        lines.groupBy(*_LINE)
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("_site", SKETCH_BITS)).alias("sites"), F.min(place).alias("first"))
        .filter(F.col("sites") >= min_sites * (1 - band)),
        "spread",
    )
    clear = F.col("sites") > min_sites * (1 + band)
    near = spread.filter(~clear)
    exact = (
        join_small(lines.select(*_LINE, "_site"), near.select(*_LINE), _LINE, "left_semi")
        .distinct()
        .groupBy(*_LINE)
        .agg(F.count("_site").alias("exact"))
        .filter(F.col("exact") >= min_sites)
    )
    return write_table(spread.filter(clear).unionByName(near.join(exact, _LINE, "left_semi")).select(*_LINE, "first"), "boilerplate")


def remove_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    site_col: str = "source",
    text_col: str = "text",
    min_sites: int = MIN_SITES,
    keep_first: bool = True,
) -> DataFrame:
    """All rows and columns, the text without boilerplate lines, and n_lines and n_removed.

    Lines count without white space at their ends; blank lines always stay. With keep_first the
    occurrence of the smallest id (null ids come last; of different texts of one id, one of them)
    stays, so that no content leaves the corpus. Rows that repeat an id and text fare alike. Null texts stay null; null sites don't count as
    a site, though lines of such rows are removed like others. A column named n_lines or n_removed
    is replaced. An empty table stays empty.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    clash = {c: f"_own{c}" for c in columns if c in (*_ROW, "_gone")}
    docs = docs.withColumnsRenamed(clash)
    back = {v: k for k, v in clash.items()}
    columns = [clash.get(c, c) for c in columns]
    # a key by content: the same in every branch of the plan and after a lost executor
    held = [F.col(id_col), F.col(text_col)]
    keys = [F.xxhash64(*held).alias("_r"), F.xxhash64(F.lit(1), *held).alias("_s")]
    rows = docs.select(*[F.col(c) for c in columns], *keys)
    lines = frequent(occurrences(rows, id_col, site_col, text_col), min_sites)
    hits = join_small(lines, boilerplate(lines, min_sites), _LINE, "inner")
    if keep_first:
        first = (F.col("_r") == F.col("first.r")) & (F.col("_s") == F.col("first.s")) & (F.col("_at") == F.col("first.at"))
        hits = hits.filter(~first)
    gone = hits.groupBy(*_ROW).agg(F.collect_set("_at").alias("_gone"))
    joined = rows.join(gone, list(_ROW), "left")
    left = let(
        _lines(F.col(text_col)),
        lambda x: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("_gone")), lambda i: x[i]), "\n"
        ),
    )
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(left)
    visible = F.filter(_lines(F.col(text_col)), lambda x: F.btrim(x, F.lit(WHITESPACE)) != "")
    return joined.select(
        *[(text if c == text_col else F.col(c)).alias(back.get(c, c)) for c in columns],
        F.size(visible).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def oracle(min_sites: int = MIN_SITES, table: str = "documents") -> str:
    """DuckDB: doc_id, source, text without boilerplate, n_lines, n_removed and all other columns as d.*."""
    return f"""
WITH raw AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM {table}
), lines AS (
  SELECT doc_id, source, line, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS word FROM raw
), found AS (
  SELECT word, min(struct_pack(doc_id := doc_id, pos := pos)) AS first
  FROM lines WHERE word <> '' GROUP BY word HAVING count(DISTINCT source) >= {min_sites}
), marked AS (
  SELECT l.doc_id, l.line, l.pos, l.word, f.word IS NOT NULL AND NOT (f.first.doc_id = l.doc_id AND f.first.pos = l.pos) AS gone
  FROM lines l LEFT JOIN found f ON l.word = f.word
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*) FILTER (WHERE word <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
FROM marked GROUP BY doc_id"""
