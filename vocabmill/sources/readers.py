"""Readers of the source formats. Every text column is read as a string and cast where it is used; nothing is inferred."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def strings(columns: list[str]) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def delimited(spark: SparkSession, path: str, columns: list[str], sep: str = "\t", header: bool = True, comment: str = "") -> DataFrame:
    """Tab, comma or pipe separated text; quotes are ordinary characters; globs and .gz are Spark's own."""
    r = spark.read.option("sep", sep).option("header", header).option("quote", "").option("escape", "").option("enforceSchema", True)
    return (r.option("comment", comment) if comment else r).schema(strings(columns)).csv(path)


def active(rows: DataFrame, *also: str) -> DataFrame:
    """Rows of a release that are in force."""
    out = rows.where("active = '1'")
    for c in also:
        out = out.where(c)
    return out


def pipe_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of a pipe-separated release file, whose lines end in a separator."""
    return delimited(spark, path, [*columns, "_end"], "|", header=False).drop("_end")


def mappings(spark: SparkSession, path: str) -> DataFrame:
    """Simple standard for sharing mappings: TSV with a commented head."""
    return delimited(spark, path, ["subject_id", "predicate_id", "object_id", "subject_label", "object_label", "mapping_justification"], comment="#")


def enveloped(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON envelope ``{"rows": [...]}``."""
    return spark.read.schema(f"rows array<struct<{schema}>>").option("multiLine", True).json(path).select(F.explode("rows").alias("r")).select("r.*")


def xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def obo(spark: SparkSession, path: str) -> DataFrame:
    """id, name, is_a[], xref[], xref_line[] (with annotations), relationship[], obsolete of an ontology's terms.

    The file is read in stanzas (blank-line separated records), so any number of tasks can share a file.
    """
    stanza = spark.read.option("lineSep", "\n\n").text(path).where(F.ltrim("value", F.lit("\n")).startswith("[Term]"))
    one = lambda tag: F.nullif(F.regexp_extract("value", f"(?m)^{tag}: ([^\\n]*)$", 1), F.lit(""))
    each = lambda tag, rest: F.regexp_extract_all("value", F.lit(f"(?m)^{tag}: {rest}"), 1)
    return stanza.select(
        one("id").alias("id"), one("name").alias("name"), each("is_a", "(\\S+)").alias("is_a"), each("xref", "(\\S+)").alias("xref"), each("xref", "([^\\n]+)").alias("xref_line"),
        each("relationship", "([^!\\n]*[^! \\n])").alias("relationship"), (one("is_obsolete") == "true").alias("_o"),
    ).withColumn("obsolete", F.coalesce("_o", F.lit(False))).drop("_o")


_COPY = re.compile(r"COPY (?:\w+\.)?\"?(\w+)\"? \(([^)]*)\) FROM stdin;$")
#: Escapes of a dump's cells.
_ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}


def unescaped(cell: str) -> str | None:
    """A dump's cell, its escapes undone from left to right; ``\\N`` is null."""
    return None if cell == "\\N" else re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), cell, flags=re.S) if "\\" in cell else cell


def dump_table(spark: SparkSession, path: str, table: str, columns: list[str]) -> DataFrame:
    """Rows of one table in a plain database dump (``COPY t (c, ...) FROM stdin;`` ... ``\\.``).

    Lines are read in the file's splits, so any number of tasks share a large table. A first pass finds the few lines that open and end
    blocks (as many as the dump has tables); with them every split knows in which block it begins.
    """
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))

    def edges(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("value", "file", "at")), strict=True)
            found = [(f, a, v) for v, f, a in rows if v == "\\." or v.startswith("COPY ")]
            yield pa.record_batch({"file": pa.array([x[0] for x in found], pa.string()), "at": pa.array([x[1] for x in found], pa.int64()), "value": pa.array([x[2] for x in found], pa.string())})

    begun, state = {}, {}  # (file, split) -> the line that its first line stands under
    splits = {}
    for r in text.mapInArrow(edges, "file string, at bigint, value string").collect():  # in the order of the splits' lines
        splits.setdefault((r.file, r.at), []).append(r.value)
    for r in text.select("file", "at").distinct().orderBy("file", "at").collect():  # a row a split
        begun[r.file, r.at] = state.get(r.file, "")
        state[r.file] = splits.get((r.file, r.at), [state.get(r.file, "")])[-1]

    def rows(batches):
        here, place = None, None
        for batch in batches:
            out = [[] for _ in columns]
            for value, file, at in zip(*(batch.column(c).to_pylist() for c in ("value", "file", "at")), strict=True):
                if (file, at) != here:
                    here, place = (file, at), places(begun.get((file, at), ""))
                if value == "\\." or value.startswith("COPY "):
                    place = places(value)
                elif place is not None:
                    cells = value.split("\t")
                    for k, j in enumerate(place):
                        out[k].append(unescaped(cells[j]) if j is not None and j < len(cells) else None)
            yield pa.record_batch([pa.array(x, pa.string()) for x in out], names=columns)

    def places(line: str) -> list[int | None] | None:
        m = _COPY.match(line)
        if not m or m[1] != table:
            return None
        names = [x.strip(' "') for x in m[2].split(",")]
        return [names.index(c) if c in names else None for c in columns]

    return text.mapInArrow(rows, strings(columns))


_PART = re.compile(r"(ObjectSomeValuesFrom\(:609096000 )|([A-Za-z]+)\(|(\))|(?<=[(])?:(\d+) (?::(\d+)|\"([^\"]*)\")")


def _groups(axiom: str | None) -> list[dict]:
    """One walk over the brackets: a role group is open until its own bracket closes."""
    out, depth, group, opened = [], 0, 0, []
    for m in _PART.finditer(axiom or ""):
        if m[1]:
            depth, group = depth + 1, group + 1
            opened.append((depth, group))
        elif m[2]:
            depth += 1
        elif m[3]:
            if opened and opened[-1][0] == depth:
                opened.pop()
            depth -= 1
        elif m[4]:
            out.append({"grp": opened[-1][1] if opened else 0, "attribute": m[4], "value": m[5] if m[5] is not None else m[6]})
    return out


def axiom_groups(axiom):
    """Role groups of a functional-syntax axiom: array of (grp, attribute, value) for its plain and concrete restrictions.

    A group is an ``ObjectSomeValuesFrom(:609096000 ...)`` up to the bracket that closes it; restrictions outside groups have group 0.
    """
    read = F.pandas_udf(lambda x: x.map(_groups), "array<struct<grp int, attribute string, value string>>")
    return read(axiom)


def literal(raw):
    """(datatype, value_num, value_str) of ``#3``, ``#12.5`` or ``"text"``; a number of any size."""
    text = raw.startswith('"')
    kind = F.when(text, "string").when(raw.rlike("^#.*\\.."), "decimal").otherwise("integer")
    return F.struct(kind.alias("datatype"), F.when(raw.startswith("#"), F.substr(raw, F.lit(2)).try_cast("double")).alias("value_num"), F.when(text, F.trim(raw, F.lit('"'))).alias("value_str"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of input files, to be compared with a recorded manifest."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return f.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    w = df.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(partition) if partition else w).parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = "\t") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
