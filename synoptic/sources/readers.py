"""Readers of the lists' formats. Each gives rows of text or the long form (uri, attr, value).

Files are read by Spark as text, XML or JSON; what has no reader of its own (Turtle, HTML) is parsed by Arrow functions
on whole files, so files are spread over tasks and nothing passes through the driver.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synoptic.model import TRIPLES

LONG = "uri string, attr string, value string"


# Turtle --------------------------------------------------------------------------------------------------------------

_TURTLE = re.compile(r'"""(?:[^"\\]|\\.|"(?!""))*"""|"(?:[^"\\\n]|\\.)*"|<[^>]*>|@prefix|@base|@[A-Za-z][\w-]*|\^\^|#[^\n]*|[;,.\[\]()](?=\s|$)|[;,\[\]()]|[^\s;,\[\]()"<>]+?(?=[;,\[\]()"<>\s]|\.(?:\s|$)|$)')
_RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", '"': '"', "\\": "\\", "'": "'"}


def parse_turtle(text: str, scope: str = "") -> list[tuple]:
    """(subj, pred, obj, obj_kind, datatype, lang) of a Turtle text: prefixes, ; and , lists, blank nodes by name and in
    brackets, collections, literals with language or datatype. `scope` goes into the names of blank nodes, which are a
    file's own."""
    prefixes, out, tokens, pos, blanks = {}, [], [t for t in _TURTLE.findall(text) if not t.startswith("#")], 0, 0

    def name(t: str) -> str:
        if t.startswith("<"):
            return prefixes.get("@base", "") + t[1:-1] if "://" not in t and not t.startswith("<urn:") else t[1:-1]
        if t == "a":
            return _RDF + "type"
        head, _, tail = t.partition(":")
        if head == "_":
            return f"_:{scope}{tail}"
        return prefixes[head] + tail if head in prefixes else t

    def predicates(subject: str, close: str) -> None:
        nonlocal pos
        while pos < len(tokens) and tokens[pos] != close:
            if tokens[pos] == ";":
                pos += 1
                continue
            pred = name(tokens[pos])
            pos += 1
            while True:
                out.append((subject, pred, *value()))
                if pos < len(tokens) and tokens[pos] == ",":
                    pos += 1
                    continue
                break
        pos += 1

    def value() -> tuple:
        nonlocal pos
        t = tokens[pos]
        pos += 1
        if t == "[":
            node = blank()
            predicates(node, "]")
            return node, "blank", None, None
        if t == "(":
            items = []
            while pos < len(tokens) and tokens[pos] != ")":
                items.append(value())
            pos += 1
            nodes = [blank() for _ in items]
            for i, (node, item) in enumerate(zip(nodes, items, strict=True)):
                out.append((node, _RDF + "first", *item))
                out.append((node, _RDF + "rest", *((nodes[i + 1], "blank") if i + 1 < len(nodes) else (_RDF + "nil", "uri")), None, None))
            return (nodes[0], "blank", None, None) if nodes else (_RDF + "nil", "uri", None, None)
        if t.startswith('"'):
            body = t[3:-3] if t.startswith('"""') else t[1:-1]
            body = re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), body)
            if pos < len(tokens) and tokens[pos].startswith("@") and tokens[pos] not in ("@prefix", "@base"):
                pos += 1
                return body, "literal", None, tokens[pos - 1][1:]
            if pos < len(tokens) and tokens[pos] == "^^":
                pos += 2
                return body, "literal", name(tokens[pos - 1]), None
            return body, "literal", None, None
        if re.fullmatch(r"[+-]?\d+", t):
            return t, "literal", "integer", None
        if re.fullmatch(r"[+-]?\d*\.?\d+(?:[eE][+-]?\d+)?", t):
            return t, "literal", "decimal", None
        if t in ("true", "false"):
            return t, "literal", "boolean", None
        return name(t), "blank" if t.startswith("_:") else "uri", None, None

    def blank() -> str:
        nonlocal blanks
        blanks += 1
        return f"_:{scope}b{blanks}"

    while pos < len(tokens):
        if tokens[pos].lower() in ("@prefix", "prefix"):
            prefixes[tokens[pos + 1].rstrip(":")] = tokens[pos + 2][1:-1]
            pos += 3
        elif tokens[pos].lower() in ("@base", "base"):
            prefixes["@base"] = tokens[pos + 1][1:-1]
            pos += 2
        elif tokens[pos] == ".":
            pos += 1
        elif tokens[pos] in ("[", "("):
            subject = value()[0]
            predicates(subject, ".")
        else:
            subject = name(tokens[pos])
            pos += 1
            predicates(subject, ".")
    return out


def turtle(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The triples of all files, each once. Blank nodes are named after their file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            yield pd.DataFrame([t for text, scope in zip(df["value"], df["scope"], strict=True) for t in parse_turtle(text, scope)], columns=TRIPLES.names)

    files = spark.read.text(paths, wholetext=True).select("value", F.concat(F.lit("f"), F.substring(F.sha2("_metadata.file_path", 256), 1, 16)).alias("scope"))
    return files.mapInPandas(run, TRIPLES).distinct()


# HTML ----------------------------------------------------------------------------------------------------------------


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.rows, self.links, self.paragraphs, self.pre = [], [], [], []
        self.cell: list[str] | None = None
        self.into: list[list[str]] = []

    def _close(self) -> None:
        """Cells end with the next cell or row, if not before."""
        if self.cell is not None:
            self.rows[-1].append(re.sub(r"\s+", " ", "".join(self.cell)).strip())
            self.cell = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("tr", "td", "th"):
            self._close()
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            if not self.rows:
                self.rows.append([])
            self.cell = []
        elif tag == "a" and (href := dict(attrs).get("href")):
            self.links.append(href)
        if tag in ("p", "pre"):
            self.into.append([])

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self._close()
        if tag in ("p", "pre") and self.into:
            (self.paragraphs if tag == "p" else self.pre).append("".join(self.into.pop()))

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)
        for t in self.into:
            t.append(data)


def parse_html(html: str) -> _Tables:
    p = _Tables()
    p.feed(html)
    p.close()
    return p


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def html_rows(pages: pd.Series) -> pd.Series:
    return pages.map(lambda h: [r for r in parse_html(h).rows if r], na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def html_links(pages: pd.Series) -> pd.Series:
    return pages.map(lambda h: parse_html(h).links, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def html_preformatted(pages: pd.Series) -> pd.Series:
    return pages.map(lambda h: parse_html(h).pre, na_action="ignore")


@F.pandas_udf(T.StringType())
def first_paragraph(pages: pd.Series) -> pd.Series:
    """The first of the first five paragraphs that is not empty."""
    return pages.map(lambda h: next((p.strip() for p in parse_html(h).paragraphs[:5] if p.strip()), None), na_action="ignore")


def html_table(pages: DataFrame, html: str, key_column: int = 0) -> DataFrame:
    """(uri, attr, value): the cells of every table row under the heads of the first one."""
    rows = pages.select(html_rows(html).alias("t")).where(F.size("t") > 1).select(F.element_at("t", 1).alias("head"), F.explode(F.slice("t", 2, 1 << 30)).alias("row"))
    cells = rows.select(F.get("row", F.lit(key_column)).alias("uri"), F.posexplode("row").alias("at", "value"), "head")
    return cells.select("uri", F.lower(F.get("head", F.col("at"))).alias("attr"), "value").where("attr is not null and value <> ''")


def two_column_page(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(uri, attr, value) from detail pages of name-value rows."""
    return pages.select(F.col(key).alias("uri"), F.explode(html_rows(html)).alias("r")).where(F.size("r") == 2).select("uri", F.lower(F.regexp_replace(F.get("r", F.lit(0)), ":$", "")).alias("attr"), F.get("r", F.lit(1)).alias("value"))


# Text of fixed columns and records -----------------------------------------------------------------------------------


def fixed_width(lines: DataFrame, column: str, fields: dict[str, tuple[int, int, str]]) -> DataFrame:
    """Fields (from, to, type) of each line; a field that does not parse is null."""
    return lines.select(*[F.nullif(F.trim(F.substring(column, a + 1, b - a)), F.lit("")).try_cast(kind).alias(n) for n, (a, b, kind) in fields.items()])


#: The columns of a list of observatory codes.
OBSERVATORY_CODES = {"code": (0, 3, "string"), "longitude": (3, 13, "double"), "rho_cos": (13, 21, "double"), "rho_sin": (21, 30, "double"), "label": (30, 200, "string")}


def observatory_codes(lines: DataFrame, column: str = "value") -> DataFrame:
    from synoptic.functions.geo import geodetic_latitude, wrapped_longitude

    rows = fixed_width(lines.where(F.col(column).rlike(r"^[0-9A-Za-z]{3}\s")), column, OBSERVATORY_CODES)
    return rows.where("code is not null and label is not null and code <> 'Cod'").select("code", "label", wrapped_longitude(F.col("longitude")).alias("longitude"), geodetic_latitude(F.col("rho_cos"), F.col("rho_sin")).alias("latitude"))


def key_value_blocks(lines: DataFrame, text: str) -> DataFrame:
    """(uri, attr, value) of "key = value" blocks that are separated by empty lines; the first value names the block."""
    blocks = lines.select(F.explode(F.split(text, r"\n\s*\n")).alias("b")).where(F.trim("b") != "")
    pairs = F.filter(F.transform(F.split("b", "\n"), lambda x: F.split(x, r"\s*=\s*", 2)), lambda x: F.size(x) == 2)
    return blocks.select(pairs.alias("p")).where(F.size("p") > 0).select(F.trim(F.get(F.get("p", F.lit(0)), F.lit(1))).alias("uri"), F.explode("p").alias("kv")).select("uri", F.lower(F.trim(F.get("kv", F.lit(0)))).alias("attr"), F.trim(F.get("kv", F.lit(1))).alias("value"))


def delimited(spark: SparkSession, path: str, sep: str, header: bool = True) -> DataFrame:
    return spark.read.csv(path, sep=sep, header=header)


def quoted_codes(text: Column) -> Column:
    """(code, name) pairs of preformatted lines: 123 'NAME'."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(-?\d+\s+'[^']*')"), 1), lambda m: F.struct(F.regexp_extract(m, r"^(-?\d+)", 1).cast("int").alias("code"), F.regexp_extract(m, r"'\s*([^']*?)\s*'", 1).alias("name")))


# JSON, XML -----------------------------------------------------------------------------------------------------------


def _leaves(x: object, path: str) -> Iterator[tuple[str, str]]:
    if isinstance(x, dict):
        for k, v in x.items():
            # A link's own description is no attribute of the record.
            if k in ("Name", "Description") and "URL" in x:
                continue
            yield from _leaves(v, k)
    elif isinstance(x, list):
        for v in x:
            yield from _leaves(v, path)
    elif x is not None:
        yield path, str(x)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("attr", T.StringType()), T.StructField("value", T.StringType())])))
def json_leaves(texts: pd.Series) -> pd.Series:
    """All leaves of a JSON text, depth first, by the name of their last key; none where it does not parse."""

    def one(text: str) -> list[dict]:
        try:
            return [{"attr": a, "value": v} for a, v in _leaves(json.loads(text), "")]
        except ValueError:
            return []

    return texts.map(one, na_action="ignore")


def json_tree(spark: SparkSession, path: str, folders: tuple[str, ...] = ("/Observatory/", "/Instrument/")) -> DataFrame:
    """(uri, attr, value) of every .json file below folders of these names."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("uri"))
    wanted = F.lit(False)
    for f in folders:
        wanted = wanted | F.contains("uri", F.lit(f))
    return files.where(wanted).select("uri", F.explode(json_leaves("value")).alias("l")).select("uri", "l.attr", "l.value")


def paged_json(spark: SparkSession, path: str, rows: str = "data") -> DataFrame:
    """The rows of all pages, each once."""
    pages = spark.read.option("multiLine", "true").json(path)
    return pages.select(F.explode(rows).alias("r")).select("r.*").distinct()


def xml_records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).load(path)


#: Names of claims in an item's JSON.
CLAIMS = {"P31": "type", "P625": "coordinates", "P571": "start_date", "P619": "launch_date", "P576": "end_date", "P17": "country", "P361": "is_part_of", "P527": "has_part", "P247": "COSPAR_ID", "P8913": "NSSDCA_ID", "P717": "code", "P2956": "NAIF_ID", "P377": "NORAD_ID"}


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("attr", "value", "lang")])))
def item_attributes(texts: pd.Series) -> pd.Series:
    """Labels, aliases, descriptions and known claims of an item's JSON."""

    def one(text: str) -> list[dict]:
        out = []
        try:
            entities = json.loads(text).get("entities", {}).values()
        except ValueError:
            return out
        for e in entities:
            for field, attr in (("labels", "label"), ("descriptions", "description")):
                out += [{"attr": attr, "value": v["value"], "lang": k} for k, v in e.get(field, {}).items()]
            out += [{"attr": "alt_label", "value": a["value"], "lang": k} for k, vs in e.get("aliases", {}).items() for a in vs]
            for p, claims in e.get("claims", {}).items():
                for c in claims if p in CLAIMS else ():
                    v = c.get("mainsnak", {}).get("datavalue", {}).get("value")
                    if isinstance(v, dict) and "latitude" in v:
                        out += [{"attr": a, "value": str(v[a]), "lang": None} for a in ("latitude", "longitude")]
                    elif isinstance(v, dict):
                        found = v.get("id") or v.get("time") or v.get("amount") or v.get("text")
                        out += [{"attr": CLAIMS[p], "value": str(found), "lang": v.get("language")}] if found else []
                    elif v is not None:
                        out.append({"attr": CLAIMS[p], "value": str(v), "lang": None})
        return out

    return texts.map(one, na_action="ignore")


# Cleaning ------------------------------------------------------------------------------------------------------------


def cleaned_attributes(long: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Attributes under their common names, without "None" and "-", longitudes without a final E, no default dates."""
    named = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in renames.items() for x in kv]), F.col("attr")), F.col("attr")) if renames else F.col("attr")
    value = F.when(named == "longitude", F.regexp_replace("value", "E$", "")).otherwise(F.trim("value"))
    out = long.select("uri", named.alias("attr"), value.alias("value"))
    default = F.col("attr").rlike("date$") & F.col("value").startswith("2000-01-01")
    # An alternative label that is a launch designation is an identifier.
    identifier = (F.col("attr") == "alt_label") & F.col("value").rlike(r"^\d{4}-\d{3}[A-Z]$")
    out = out.withColumn("attr", F.when(identifier, "NSSDCA_ID").otherwise(F.col("attr")))
    return out.where(~F.col("value").isin("None", "-", "", "NULL", "Unknown") & ~F.coalesce(default, F.lit(False))).distinct()


def wide(long: DataFrame, single: list[str], many: list[str]) -> DataFrame:
    """One row a uri: the smallest value of single attributes, all values of the others. No pivot over data values."""
    cols = [F.min(F.when(F.col("attr") == a, F.col("value"))).alias(a) for a in single]
    cols += [F.array_sort(F.collect_set(F.when(F.col("attr") == a, F.col("value")))).alias(a) for a in many]
    return long.groupBy("uri").agg(*cols)


def cache_name(url: Column) -> Column:
    """The file name under which a page is kept."""
    return F.lower(F.regexp_replace(url, r"[^\p{L}\p{N}_]+", "_"))


def degrees(text: Column) -> Column:
    """Decimal degrees of "12 34 56 S": degrees, minutes, seconds and hemisphere."""
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(text, r"(-?\d+(?:\.\d+)?)(?:[^\d.]+(\d+(?:\.\d+)?))?(?:[^\d.]+(\d+(?:\.\d+)?))?", i), F.lit("")).cast("double"), F.lit(0.0))
    size = F.abs(part(1)) + part(2) / 60 + part(3) / 3600
    return F.when(text.rlike(r"[SWsw]\s*$") | text.startswith("-"), -size).otherwise(size)


def votes(spark: SparkSession, path: str) -> DataFrame:
    """Annotation tables: vote columns before Comments, then Entity1 and Entity2; how many say "x"."""
    table = spark.read.csv(path, sep="\t", header=True)
    cast = table.columns[: table.columns.index("Comments")]
    return table.select(F.size(F.filter(F.array(*[F.col(f"`{c}`") for c in cast]), lambda v: v == "x")).alias("yes"), F.size(F.filter(F.array(*[F.col(f"`{c}`") for c in cast]), lambda v: v == "o")).alias("no"), "Entity1", "Entity2")
