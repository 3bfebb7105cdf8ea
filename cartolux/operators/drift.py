"""Schemas that drift between files.

Every delivered file states its own columns (``#h``) and types (``#f``). The operator gives each
file a fingerprint of (field, header, type), chains the files of a stream by time, records every
change between neighbours, and keeps a registry: fingerprints numbered as versions, each with the
explicit steps that lead to the one consistent layout - rename, default, cast and keep rules in that
order, a row each (``registry``) - and the steps from each version of a stream to the next
(``migrations``). ``conformed`` routes the lines of each file by the registry's rows alone, and
``applied`` is the record of the steps each file went through.

Cases. A file without a ``#h`` line carries no schema and stays out of the chain. A file listed
twice under one id counts once. A column named twice in one header counts by its first place. A
column that ``#f`` does not reach has no declared type and is never reported as retyped unless text
shows it to be a string. Unknown columns go by their own header name and land in ``extras``. Missing
values are empty, blanks or ``NA``. Values that no cast rule can read become null in the typed
column and stay readable in ``extras`` under ``!field``. Null lines and lines of unknown files are
left out; other columns of the inputs are ignored.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import salted_join
from ..schemas import FORMATS, MINUS, PLUS, spellings

HEAD, TYPES = -1, -2
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain(*pairs.items())])


def _cells(line: Column) -> Column:
    return F.split(F.regexp_replace(line, r"\r$", ""), "\t", -1)


def _missing(cell: Column) -> Column:
    return F.trim(cell).isin("", "NA")


def file_schemas(files: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per file: stream, kind, made_at, fields array<struct<field,header,type,pos>>, fingerprint.

    One scan of the lines. Each data line is reduced at once to the places of its cells that are not
    plain numbers; these are combined before the shuffle, so a huge file costs one row per column."""
    line = F.col("line")
    cells = _cells(line)
    text_at = F.filter(
        F.transform(cells, lambda v, i: F.when(~_missing(v) & ~F.trim(v).rlike(NUMBER), i)), lambda i: i.isNotNull()
    )
    at = F.when(line.rlike("^#h[ \t]"), F.array(F.lit(HEAD))).when(line.rlike("^#f[ \t]"), F.array(F.lit(TYPES))).when(~line.startswith("#"), text_at)
    # One scan; header lines are part of the key, so all is combined by hash before the shuffle.
    seen = lines.select("file_id", "line_no", "line", F.explode(at).alias("at")).withColumn("stated", F.when(F.col("at") < 0, F.col("line")))
    seen = seen.groupBy("file_id", "at", "stated").agg(F.min("line_no").alias("line_no"))
    first = lambda tag: _cells(F.substring(F.min(F.when(F.col("at") == tag, F.struct("line_no", "stated")))["stated"], 4, 1 << 30))
    per_file = seen.groupBy("file_id").agg(first(HEAD).alias("header"), first(TYPES).alias("declared"), F.collect_set(F.when(F.col("at") >= 0, F.col("at"))).alias("text_at"))
    listed = files.filter(F.col("file_id").isNotNull()).groupBy("file_id").agg(F.min(F.struct("made_at", "stream", "kind")).alias("f"))
    known = {kind: _literal_map(spellings(kind)) for kind in FORMATS}
    kind = F.upper(F.coalesce("kind", F.when(F.exists("header", lambda h: F.lower(h) == "xmapentryid"), "XMAP").otherwise("CMAP")))

    def field(h: Column) -> Column:
        spelt = F.lower(F.regexp_replace(h, "[^A-Za-z0-9]", ""))
        return F.coalesce(F.when(F.col("kind") == "XMAP", known["XMAP"][spelt]).otherwise(known["CMAP"][spelt]), h)

    named = F.transform(
        "header",
        lambda h, i: F.struct(
            field(F.trim(h)).alias("field"),
            F.trim(h).alias("header"),
            F.when(F.array_contains("text_at", i), "string").otherwise(F.lower(F.trim(F.get("declared", i)))).alias("type"),
            i.alias("pos"),
        ),
    )
    once = F.filter("fields", lambda x, i: F.array_position(F.transform("fields", lambda y: y["field"]), x["field"]) == i + 1)
    marks = F.array_sort(F.transform("fields", lambda x: F.concat_ws("\x1f", x["field"], x["header"], F.coalesce(x["type"], F.lit("?")))))
    return (
        listed.select("file_id", "f.*")
        .join(per_file.filter("header IS NOT NULL"), "file_id")
        .withColumn("kind", kind)
        .withColumn("fields", named)
        .withColumn("fields", once)
        .withColumn("fingerprint", F.xxhash64("kind", F.array_join(marks, "\x1e")))
        .select("file_id", "stream", "kind", "made_at", "fields", "fingerprint")
    )


def chained(schemas: DataFrame) -> DataFrame:
    """Adds ``before`` (fields) and ``before_print`` of the preceding file of the stream.

    A stream may hold a third of all files, so neighbours are found within (stream, day), and only
    the first file of a day looks to the last file of the stream's day before it."""
    order = F.struct("made_at", "file_id")
    dated = schemas.withColumn("day", F.to_date("made_at")).withColumn("own", F.struct("fields", "fingerprint"))
    within = Window.partitionBy("stream", "day").orderBy("made_at", "file_id")
    days = dated.groupBy("stream", "day").agg(F.max_by("own", order).alias("last"))
    days = days.withColumn("earlier", F.lag("last").over(Window.partitionBy("stream").orderBy("day"))).drop("last")
    days = days.withColumnsRenamed({"stream": "_stream", "day": "_day"})
    same = F.col("stream").eqNullSafe(F.col("_stream")) & F.col("day").eqNullSafe(F.col("_day"))
    return (
        dated.withColumn("prev", F.lag("own").over(within))
        .join(days, same, "left")
        .withColumn("prev", F.coalesce("prev", "earlier"))
        .select(*schemas.columns, F.col("prev.fields").alias("before"), F.col("prev.fingerprint").alias("before_print"))
    )


def changes(schemas: DataFrame) -> DataFrame:
    """(file_id, field, change): what each file changed against the one before it in its stream."""

    def against(own: str, other: str, test) -> Column:
        return F.transform(F.filter(own, lambda x: test(x, other)), lambda x: x["field"])

    def absent(x: Column, other: str) -> Column:
        return ~F.exists(other, lambda y: y["field"] == x["field"])

    def differs(part: str):
        return lambda x, other: F.exists(other, lambda y: (y["field"] == x["field"]) & (y[part] != x[part]))

    found = {
        "added": against("fields", "before", absent),
        "removed": against("before", "fields", absent),
        "renamed": against("fields", "before", differs("header")),
        "retyped": against("fields", "before", differs("type")),
    }
    def tagged(change: str, fields: Column) -> Column:
        return F.transform(fields, lambda f: F.struct(f.alias("field"), F.lit(change).alias("change")))

    listed = F.concat(*[tagged(change, fields) for change, fields in found.items()])
    return (
        chained(schemas)
        .filter(F.col("before").isNotNull() & (F.col("before_print") != F.col("fingerprint")))
        .select("file_id", F.explode(listed).alias("x"))
        .select("file_id", "x.field", "x.change")
    )


STEPS = ["rename", "default", "cast", "keep"]


def _target(kind: str = "kind", field: str = "f.field") -> Column:
    """The layout's type of a field, null if the layout has no such field."""
    by_kind = {k: _literal_map(columns)[F.col(field)] for k, columns in FORMATS.items()}
    return F.when(F.col(kind) == "XMAP", by_kind["XMAP"]).otherwise(by_kind["CMAP"])


def numbered(schemas: DataFrame) -> DataFrame:
    """kind, version, fingerprint, first_file_id, n_files, fields: fingerprints of each kind numbered by their
    first file. One row per fingerprint, so the window grows with the variety of schemas, not with the files."""
    flat = schemas.groupBy("kind", "fingerprint").agg(
        F.min(F.struct("made_at", "file_id")).alias("first"), F.count("*").alias("n_files"), F.min_by("fields", F.struct("made_at", "file_id")).alias("fields")
    )
    w = Window.partitionBy("kind").orderBy("first", "fingerprint")
    return flat.select("kind", F.row_number().over(w).alias("version"), "fingerprint", F.col("first.made_at").alias("first_made_at"), F.col("first.file_id").alias("first_file_id"), "n_files", "fields")


def registry(schemas: DataFrame) -> DataFrame:
    """kind, version, fingerprint, step_no, action, field, source, target: the steps from each version to the
    layout. rename: header to field. default: a field the version lacks, null of its type. cast: the stated
    type to the layout's. keep: a field outside the layout, carried in ``extras``."""
    v = numbered(schemas)
    wanted = F.when(F.col("kind") == "XMAP", F.array(*map(F.lit, FORMATS["XMAP"]))).otherwise(F.array(*map(F.lit, FORMATS["CMAP"])))
    carried = v.select("kind", "version", "fingerprint", F.explode("fields").alias("f")).withColumn("to", _target())
    step = lambda action, field, source, target: F.struct(F.lit(action).alias("action"), field.alias("field"), source.alias("source"), target.alias("target"))
    field, stated = F.col("f.field"), F.coalesce("f.type", F.lit("?"))
    own = F.array(
        F.when(F.col("f.header") != field, step("rename", field, F.col("f.header"), field)),
        F.when(F.col("to").isNotNull(), step("cast", field, stated, F.col("to"))).otherwise(step("keep", field, stated, F.lit("extras"))),
    )
    keys = ["kind", "version", "fingerprint"]
    one = carried.select(*keys, F.explode(F.filter(own, lambda x: x.isNotNull())).alias("s")).select(*keys, "s.*")
    lacking = v.select(*keys, F.explode(F.array_except(wanted, F.transform("fields", lambda x: x["field"]))).alias("field"))
    two = lacking.select(*keys, F.lit("default").alias("action"), "field", F.lit("null").alias("source"), _target(field="field").alias("target"))
    w = Window.partitionBy(*keys).orderBy(F.array_position(F.array(*map(F.lit, STEPS)), F.col("action")), "field")
    return one.unionByName(two).select(*keys, F.row_number().over(w).alias("step_no"), "action", "field", "source", "target")


def applied(schemas: DataFrame) -> DataFrame:
    """file_id, version, step_no, action, field, source, target: every step that each file goes through."""
    steps = registry(schemas).select("fingerprint", "version", "step_no", "action", "field", "source", "target")
    return salted_join(schemas.select("file_id", "fingerprint"), steps, ["fingerprint"], [F.col("file_id")]).drop("fingerprint")


def migrations(schemas: DataFrame) -> DataFrame:
    """file_id, from_version, to_version, step_no, action, field, source, target: the steps from the version
    before to that of each file that changed it, in its stream: remove, add, rename, cast. Taken one after the
    other from a stream's first version, they give each of its versions."""
    seen = chained(schemas).filter(F.col("before").isNotNull() & (F.col("before_print") != F.col("fingerprint")))
    v = numbered(schemas).select("fingerprint", "version")
    both = seen.join(v.withColumnsRenamed({"version": "to_version"}), "fingerprint").join(v.withColumnsRenamed({"version": "from_version", "fingerprint": "before_print"}), "before_print")
    other = lambda x, side: F.filter(side, lambda y: y["field"] == x["field"])[0]
    absent = lambda x, side: ~F.exists(side, lambda y: y["field"] == x["field"])
    step = lambda action, x, source, target: F.struct(F.lit(action).alias("action"), x["field"].alias("field"), source.alias("source"), target.alias("target"))
    gone = F.transform(F.filter("before", lambda x: absent(x, "fields")), lambda x: step("remove", x, x["header"], F.lit(None).cast("string")))
    new = F.transform(F.filter("fields", lambda x: absent(x, "before")), lambda x: step("add", x, F.lit(None).cast("string"), x["header"]))
    pairs = F.transform(F.filter("fields", lambda x: ~absent(x, "before")), lambda x: F.struct(x.alias("now"), other(x, "before").alias("was")))
    named = F.transform(F.filter(pairs, lambda p: p["now"]["header"] != p["was"]["header"]), lambda p: step("rename", p["now"], p["was"]["header"], p["now"]["header"]))
    typed = F.transform(F.filter(pairs, lambda p: p["now"]["type"] != p["was"]["type"]), lambda p: step("cast", p["now"], p["was"]["type"], p["now"]["type"]))
    sorted_ = lambda steps: F.array_sort(steps, lambda a, b: F.when(a["field"] < b["field"], -1).when(a["field"] > b["field"], 1).otherwise(0))
    steps = F.concat(sorted_(gone), sorted_(new), sorted_(named), sorted_(typed))
    return both.select("file_id", "from_version", "to_version", F.posexplode(steps).alias("at", "s")).select("file_id", "from_version", "to_version", (F.col("at") + 1).alias("step_no"), "s.*")


def versions(schemas: DataFrame) -> DataFrame:
    """The registry at a glance: one row per fingerprint, its steps joined."""
    listed = lambda action, text: F.array_join(F.array_sort(F.collect_list(F.when(F.col("action") == action, text))), ",")
    steps = registry(schemas).groupBy("fingerprint").agg(
        listed("rename", F.concat("source", F.lit(">"), "field")).alias("renames"), listed("default", F.col("field")).alias("defaults"),
        listed("cast", F.concat("field", F.lit(":"), "source", F.lit(">"), "target")).alias("casts"), listed("keep", F.col("field")).alias("extras"),
    )
    return numbered(schemas).drop("fields").join(steps, "fingerprint")


def _decoded(field: str, kind: str, cell: Column) -> Column:
    """The cast rule of a field: numbers with a decimal comma, a percent sign or marks; ids with a
    prefix; channels and orientations by name."""
    cell = F.when(~_missing(cell), F.trim(cell))
    if field == "Orientation":
        return F.when(cell.isin(*PLUS), "+").when(cell.isin(*MINUS), "-")
    if field == "Strand" or kind == "string":
        return cell
    if field == "Mask":
        return F.conv(F.nullif(F.regexp_extract(cell, "^(0[xX])?([0-9A-Fa-f]+)$", 2), F.lit("")), 16, 10).try_cast("int")
    if field == "LabelChannel":
        named = F.when(cell == "end", 0).when(cell.startswith("green_"), 1).when(cell.startswith("red_"), 2)
        return F.coalesce(named, F.nullif(F.regexp_extract(cell, r"^(?:ch|L-)?([0-9]+)(?:\.0*)?$", 1), F.lit("")).try_cast("int"))
    if kind == "long":
        return F.nullif(F.regexp_extract(cell, r"^(?:[A-Za-z]+_?)?(-?[0-9]+)(?:\.0*)?$", 1), F.lit("")).try_cast("long")
    number = F.regexp_replace(F.regexp_replace(cell, ",", "."), "^q|[%*]$", "")
    number = F.when(number.rlike(NUMBER), number).try_cast("double")
    return number.cast("int") if kind == "int" else number


def conformed(schemas: DataFrame, lines: DataFrame, kind: str) -> DataFrame:
    """All data lines of one kind of file in its one consistent layout. Each line is routed by the rows that the
    registry has for its file's version: rename (the header that carries the field), default (null where the
    version lacks it), cast; ``extras`` holds what the keep rules name and values that no cast could read."""
    layout = FORMATS[kind]
    one = schemas.filter(F.col("kind") == kind)
    by = lambda action, key, value: F.map_from_entries(F.collect_list(F.when(F.col("action") == action, F.struct(F.col(key), F.col(value)))))
    rules = registry(one).groupBy("fingerprint").agg(
        F.first("version").alias("version"), by("rename", "field", "source").alias("renames"), by("cast", "field", "target").alias("casts"), by("keep", "field", "target").alias("keeps")
    )
    place = F.map_from_entries(F.transform("fields", lambda x: F.struct(x["header"], x["pos"])))
    routed = one.select("file_id", "stream", "made_at", place.alias("place"), "fingerprint").join(rules, "fingerprint")
    data = lines.filter(~F.col("line").startswith("#") & ~F.col("line").rlike(r"^[ \t]*\r?$")).select("file_id", "line_no", _cells(F.col("line")).alias("cells"))
    both = salted_join(data, routed, ["file_id"], [F.col("line_no")])
    at = lambda field: F.get("cells", F.element_at("place", F.coalesce(F.element_at("renames", field), field)))
    raw = {f: F.when(F.element_at("casts", F.lit(f)).isNotNull(), at(F.lit(f))) for f in layout}
    typed = {f: _decoded(f, k, raw[f]) for f, k in layout.items()}
    other_values = F.transform(F.array_sort(F.map_keys("keeps")), lambda k: F.struct(k.alias("key"), at(k).alias("value")))
    unread = F.array(*[F.struct(F.lit(f"!{f}").alias("key"), F.when(~_missing(raw[f]) & typed[f].isNull(), raw[f]).alias("value")) for f in layout])
    extras = F.map_from_entries(F.filter(F.concat(other_values, unread), lambda x: x["value"].isNotNull() & ~_missing(x["value"])))
    return both.select("file_id", "line_no", "stream", "made_at", "version", *[c.alias(f) for f, c in typed.items()], F.to_json(extras).alias("extras"))
