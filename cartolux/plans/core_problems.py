"""Queries p1 to p4 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import drift, intervals, malformed, orphans
from ..runtime import table
from ..schemas import FORMATS, MINUS, PLUS, spellings


def _schemas(spark: SparkSession, d: str) -> DataFrame:
    return drift.file_schemas(table(spark, d, "map_file"), table(spark, d, "map_file_line"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(_schemas(spark, d))


def p1_versions(spark: SparkSession, d: str) -> DataFrame:
    """The registry: versions of both kinds of file with the steps to the layout."""
    first = drift.numbered(_schemas(spark, d)).select("kind", "version", "first_file_id", "n_files")
    return drift.registry(_schemas(spark, d)).drop("fingerprint").join(first, ["kind", "version"])


def p1_migrations(spark: SparkSession, d: str) -> DataFrame:
    """The steps from version to version along each stream."""
    return drift.migrations(_schemas(spark, d))


def p1_applied(spark: SparkSession, d: str) -> DataFrame:
    """Every step that each file went through."""
    return drift.applied(_schemas(spark, d))


def p1_cmap(spark: SparkSession, d: str) -> DataFrame:
    return drift.conformed(_schemas(spark, d), table(spark, d, "map_file_line"), "CMAP")


def p1_xmap(spark: SparkSession, d: str) -> DataFrame:
    return drift.conformed(_schemas(spark, d), table(spark, d, "map_file_line"), "XMAP")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphans(table(spark, d, "cmap"), table(spark, d, "xmap"))


def p2_periods(spark: SparkSession, d: str) -> DataFrame:
    return orphans.per_period(p2_found(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return intervals.coverage(table(spark, d, "xmap"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return malformed.rejected(table(spark, d, "conflict_line")).select("file_id", "line_no", "reason")


def p4_offsets(spark: SparkSession, d: str) -> DataFrame:
    return malformed.rejected(table(spark, d, "conflict_line"))


def p4_valid(spark: SparkSession, d: str) -> DataFrame:
    return malformed.accepted(table(spark, d, "conflict_line"))


QUERIES = {f.__name__: f for f in (p1_found, p1_versions, p1_migrations, p1_applied, p1_cmap, p1_xmap, p2_found, p2_periods, p3_found, p4_found, p4_offsets, p4_valid)}

_SPELLINGS = ",".join(f"('{k}','{s}','{c}')" for k in FORMATS for s, c in spellings(k).items())

_P1 = f"""
WITH known(kind, spelt, field) AS (VALUES {_SPELLINGS}),
lines AS (SELECT file_id, line_no, regexp_replace(line, '\\r$', '') AS line FROM map_file_line),
heads AS (SELECT file_id, string_split(substr(line, 4), chr(9)) AS h FROM lines WHERE line LIKE '#h%'),
types AS (SELECT file_id, string_split(substr(line, 4), chr(9)) AS t FROM lines WHERE line LIKE '#f%'),
cells AS (SELECT file_id, unnest(string_split(line, chr(9))) AS v, generate_subscripts(string_split(line, chr(9)), 1) AS pos FROM lines WHERE line NOT LIKE '#%'),
texts AS (SELECT DISTINCT file_id, pos FROM cells WHERE trim(v) NOT IN ('', 'NA') AND NOT regexp_full_match(trim(v), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)')),
named AS (SELECT file_id, unnest(h) AS header, unnest(t) AS declared, generate_subscripts(h, 1) AS pos FROM heads JOIN types USING (file_id)),
fields AS (
  SELECT n.file_id, coalesce(k.field, n.header) AS field, n.header, CASE WHEN x.pos IS NOT NULL THEN 'string' ELSE n.declared END AS type
  FROM named n JOIN map_file f USING (file_id)
  LEFT JOIN known k ON k.kind = f.kind AND k.spelt = lower(regexp_replace(n.header, '[^A-Za-z0-9]', '', 'g'))
  LEFT JOIN texts x ON x.file_id = n.file_id AND x.pos = n.pos),
pairs AS (SELECT file_id, lag(file_id) OVER (PARTITION BY stream ORDER BY made_at, file_id) AS prev FROM map_file WHERE file_id IN (SELECT file_id FROM heads)),
now AS (SELECT p.file_id, f.field, f.header, f.type FROM pairs p JOIN fields f ON f.file_id = p.file_id WHERE p.prev IS NOT NULL),
was AS (SELECT p.file_id, f.field, f.header, f.type FROM pairs p JOIN fields f ON f.file_id = p.prev)
"""
P1 = _P1 + """SELECT file_id, field, unnest(list_filter([CASE WHEN w.header IS NULL THEN 'added' END, CASE WHEN n.header IS NULL THEN 'removed' END,
  CASE WHEN w.header <> n.header THEN 'renamed' END, CASE WHEN w.type <> n.type THEN 'retyped' END], lambda x: x IS NOT NULL)) AS change
FROM now n FULL JOIN was w USING (file_id, field)
"""

_LAYOUTS = ",".join(f"('{k}',{i},'{c}','{t}')" for k, columns in FORMATS.items() for i, (c, t) in enumerate(columns.items()))
_REGISTRY = _P1.rstrip() + f""",
layouts(kind, spot, field, target) AS (VALUES {_LAYOUTS}),
signed AS (SELECT f.file_id, m.kind, m.made_at, m.stream, string_agg(f.field || chr(31) || f.header || chr(31) || coalesce(f.type, '?'), chr(30) ORDER BY f.field) AS sig FROM fields f JOIN (SELECT file_id, min(made_at) AS made_at, min(kind) AS kind, min(stream) AS stream FROM map_file GROUP BY 1) m USING (file_id) GROUP BY ALL),
numbered AS (SELECT kind, sig, count(*) AS n_files, arg_min(file_id, {{'m': made_at, 'f': file_id}}) AS first_file_id, row_number() OVER (PARTITION BY kind ORDER BY min({{'m': made_at, 'f': file_id}})) AS version FROM signed GROUP BY kind, sig),
of_file AS (SELECT s.file_id, s.kind, s.stream, s.made_at, version FROM signed s JOIN numbered n USING (kind, sig)),
carried AS (SELECT DISTINCT n.kind, n.version, f.field, f.header, f.type FROM numbered n JOIN fields f ON f.file_id = n.first_file_id),
steps AS (
  SELECT kind, version, 1 AS o, 'rename' AS action, field, header AS source, field AS target FROM carried WHERE header <> field
  UNION ALL SELECT n.kind, n.version, 2, 'default', l.field, 'null', l.target FROM numbered n JOIN layouts l ON l.kind = n.kind WHERE NOT EXISTS (SELECT 1 FROM carried c WHERE c.kind = n.kind AND c.version = n.version AND c.field = l.field)
  UNION ALL SELECT c.kind, version, CASE WHEN l.field IS NULL THEN 4 ELSE 3 END, CASE WHEN l.field IS NULL THEN 'keep' ELSE 'cast' END, c.field, coalesce(type, '?'), coalesce(l.target, 'extras') FROM carried c LEFT JOIN layouts l ON l.kind = c.kind AND l.field = c.field),
reg AS (SELECT *, row_number() OVER (PARTITION BY kind, version ORDER BY o, field) AS step_no FROM steps)
"""


def _conformed(kind: str) -> str:
    def typed(field: str, target: str) -> str:
        c = f"nullif(nullif(trim(max(CASE WHEN field = '{field}' THEN v END)), ''), 'NA')"
        if field == "Orientation":
            listed = lambda values: ", ".join(f"'{v}'" for v in values)
            return f"CASE WHEN {c} IN ({listed(PLUS)}) THEN '+' WHEN {c} IN ({listed(MINUS)}) THEN '-' END"
        if target == "string":
            return c
        if field == "Mask":
            return f"CASE WHEN regexp_full_match({c}, '(0[xX])?[0-9A-Fa-f]+') THEN TRY_CAST('0x' || regexp_replace({c}, '^0[xX]', '') AS INTEGER) END"
        if field == "LabelChannel":
            return f"coalesce(CASE WHEN {c} = 'end' THEN 0 WHEN {c} LIKE 'green\\_%' ESCAPE '\\' THEN 1 WHEN {c} LIKE 'red\\_%' ESCAPE '\\' THEN 2 END, TRY_CAST(regexp_extract({c}, '^(?:ch|L-)?([0-9]+)(?:\\.0*)?$', 1) AS INTEGER))"
        if target == "long":
            return f"TRY_CAST(regexp_extract({c}, '^(?:[A-Za-z]+_?)?(-?[0-9]+)(?:\\.0*)?$', 1) AS BIGINT)"
        n = f"regexp_replace(replace({c}, ',', '.'), '^q|[%*]$', '', 'g')"
        n = f"CASE WHEN regexp_full_match({n}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') THEN TRY_CAST({n} AS DOUBLE) END"
        return f"CAST(trunc({n}) AS INTEGER)" if target == "int" else n

    layout = FORMATS[kind]
    columns = ", ".join(f'{typed(f, t)} AS "{f}"' for f, t in layout.items())
    unread = " ".join(f"WHEN t.\"{f}\" IS NULL AND l.field = '{f}' THEN '!{f}'" for f in layout)
    return _REGISTRY.rstrip() + f""",
placed AS (SELECT l.file_id, l.line_no, n.pos, n.header, unnest(string_split(l.line, chr(9))) AS v, generate_subscripts(string_split(l.line, chr(9)), 1) AS spot FROM (SELECT DISTINCT * FROM lines WHERE line NOT LIKE '#%' AND NOT regexp_full_match(line, '[ \\t]*')) l JOIN (SELECT 1 AS pos, '' AS header) n ON true),
long AS (SELECT p.file_id, p.line_no, coalesce(k.field, n.header) AS field, p.v FROM placed p JOIN of_file o ON o.file_id = p.file_id AND o.kind = '{kind}'
  JOIN named n ON n.file_id = p.file_id AND n.pos = p.spot LEFT JOIN known k ON k.kind = o.kind AND k.spelt = lower(regexp_replace(n.header, '[^A-Za-z0-9]', '', 'g'))),
typed AS (SELECT file_id, line_no, {columns} FROM long GROUP BY 1, 2),
rest AS (SELECT l.file_id, l.line_no, y.spot, CASE WHEN y.field IS NULL THEN l.field {unread} END AS key, l.v FROM long l JOIN typed t USING (file_id, line_no) LEFT JOIN layouts y ON y.kind = '{kind}' AND y.field = l.field WHERE trim(l.v) NOT IN ('', 'NA')),
more AS (SELECT file_id, line_no, string_agg('"' || key || '":' || CAST(to_json(v) AS VARCHAR), ',' ORDER BY coalesce(spot, -1), key) AS x FROM rest WHERE key IS NOT NULL GROUP BY 1, 2)
SELECT t.file_id, t.line_no, stream, made_at, version, {", ".join(f't."{f}"' for f in layout)}, '{{' || coalesce(x, '') || '}}' AS extras FROM typed t JOIN of_file USING (file_id) LEFT JOIN more m ON m.file_id = t.file_id AND m.line_no = t.line_no"""


P2 = """
WITH maps AS (
  SELECT CMapId AS id, min(loaded_at) AS loaded, min(retired_at) AS retired, max(CASE WHEN NOT isnan(ContigLength) THEN ContigLength END) AS len FROM cmap WHERE CMapId IS NOT NULL GROUP BY 1),
refs AS (
  SELECT XmapEntryID, aligned_at, 'qry' AS side, QryContigID AS id, QryLen AS len FROM xmap
  UNION ALL SELECT XmapEntryID, aligned_at, 'ref', RefContigID, RefLen FROM xmap),
judged AS (
  SELECT XmapEntryID AS xmapentryid, side, CASE WHEN m.id IS NULL THEN 'missing' WHEN m.loaded > r.aligned_at THEN 'late'
    WHEN m.retired <= r.aligned_at THEN 'deleted' WHEN abs(r.len - m.len) > 1.0 THEN 'length' END AS reason, strftime(r.aligned_at, '%Y-%m') AS period
  FROM refs r LEFT JOIN maps m ON m.id = r.id WHERE r.id IS NOT NULL)
SELECT DISTINCT xmapentryid, side, reason, period FROM judged WHERE reason IS NOT NULL
"""

P3 = """
WITH spans AS (
  SELECT aln_set, RefContigID AS id, CAST(round(RefStartPos * 10) AS BIGINT) AS a, CAST(round(coalesce(RefEndPos, RefStartPos + QryLen) * 10) AS BIGINT) AS b
  FROM xmap WHERE RefContigID IS NOT NULL AND RefStartPos IS NOT NULL AND coalesce(RefEndPos, RefStartPos + QryLen) IS NOT NULL),
placed AS (SELECT DISTINCT aln_set, id, least(a, b) AS lo, greatest(a, b) AS hi FROM spans),
reach AS (SELECT *, max(hi) OVER (PARTITION BY aln_set, id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS so_far FROM placed),
marked AS (SELECT *, sum(CASE WHEN so_far IS NULL OR lo > so_far THEN 1 ELSE 0 END) OVER (PARTITION BY aln_set, id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS n FROM reach),
periods AS (SELECT aln_set, id, n, min(lo) AS lo, max(hi) AS hi FROM marked GROUP BY ALL),
nexts AS (SELECT *, lead(lo) OVER (PARTITION BY aln_set, id ORDER BY lo) AS next FROM periods)
SELECT aln_set, id AS refcontigid, 'period' AS kind, lo AS start_dbp, hi AS end_dbp FROM periods
UNION ALL SELECT aln_set, id, 'gap', hi, next FROM nexts WHERE next IS NOT NULL
"""

_F = r"""
WITH rows AS (SELECT file_id, line_no, regexp_replace(line, '\r$', '') AS line FROM conflict_line WHERE line NOT LIKE '#%'),
content AS (SELECT * FROM rows WHERE NOT regexp_full_match(line, '[ \t]*')),
quoted AS (SELECT *, regexp_full_match(line, '("([^"]|"")*"|[^"\t]([^"\t])*|)(\t("([^"]|"")*"|[^"\t]([^"\t])*|))*') AS ok FROM content),
fields AS (SELECT *, CASE WHEN ok THEN list_transform(regexp_extract_all(chr(9) || line, '\t("(?:[^"]|"")*"|[^"\t]*)', 1),
  lambda x: trim(CASE WHEN x LIKE '"%' THEN replace(substr(x, 2, length(x) - 2), '""', '"') ELSE x END, ' ')) END AS f FROM quoted),
judged AS (SELECT *, CASE WHEN NOT ok THEN 'quoting' WHEN len(f) <> 18 THEN 'columns'
  WHEN NOT (regexp_full_match(f[1], '[0-9]+|-1') AND regexp_full_match(f[3], '[0-9]+|-1') AND regexp_full_match(f[11], '[0-9]+|-1')) THEN 'bad_id'
  WHEN NOT (regexp_full_match(f[4], '[0-9]+(\.[0-9]*)?|-1') AND regexp_full_match(f[5], '[0-9]+(\.[0-9]*)?|-1') AND regexp_full_match(f[12], '[0-9]+(\.[0-9]*)?|-1') AND regexp_full_match(f[13], '[0-9]+(\.[0-9]*)?|-1')) THEN 'bad_bkpt'
  WHEN NOT (f[6] IN ('+', '-') AND f[14] IN ('+', '-')) THEN 'bad_orientation'
  WHEN NOT (lower(f[7]) IN ('okay', 'cut', '-') AND lower(f[8]) IN ('okay', 'cut', '-') AND lower(f[15]) IN ('okay', 'cut', '-') AND lower(f[16]) IN ('okay', 'cut', '-')
    AND lower(f[9]) IN ('okay', 'exclude', '-') AND lower(f[17]) IN ('okay', 'exclude', '-')) THEN 'bad_status' END AS reason FROM fields)
"""

_NAMES = ["xId", "ref", "refId", "refLeftBkpt", "refRightBkpt", "refOrientation", "refLeftBkptStatus", "refRightBkptStatus", "refStatus", "qry", "qryId", "qryLeftBkpt", "qryRightBkpt", "qryOrientation", "qryLeftBkptStatus", "qryRightBkptStatus", "qryStatus", "remark"]
_TYPED = ", ".join(
    (f"TRY_CAST(f[{i}] AS BIGINT)" if n.endswith("Id") else f"TRY_CAST(f[{i}] AS DOUBLE)" if n.endswith("Bkpt") else f"lower(f[{i}])" if n.endswith("Status") else f"f[{i}]") + f' AS "{n}"'
    for i, n in enumerate(_NAMES, 1)
)

ORACLES = {
    "p1_found": P1,
    "p1_versions": _REGISTRY + "SELECT r.kind, r.version, step_no, action, field, source, target, first_file_id, n_files FROM reg r JOIN numbered n ON n.kind = r.kind AND n.version = r.version",
    "p1_applied": _REGISTRY + "SELECT file_id, r.version, step_no, action, field, source, target FROM of_file f JOIN reg r ON r.kind = f.kind AND r.version = f.version",
    "p1_migrations": _REGISTRY.rstrip() + """,
moves AS (
  SELECT coalesce(n.file_id, w.file_id) AS file_id, coalesce(n.field, w.field) AS field, unnest(list_filter([
    CASE WHEN n.header IS NULL THEN {'o': 1, 'action': 'remove', 'source': w.header, 'target': NULL} END, CASE WHEN w.header IS NULL THEN {'o': 2, 'action': 'add', 'source': NULL, 'target': n.header} END,
    CASE WHEN w.header <> n.header THEN {'o': 3, 'action': 'rename', 'source': w.header, 'target': n.header} END, CASE WHEN w.type <> n.type THEN {'o': 4, 'action': 'cast', 'source': w.type, 'target': n.type} END], lambda x: x IS NOT NULL)) AS s
  FROM now n FULL JOIN was w ON n.file_id = w.file_id AND n.field = w.field)
SELECT m.file_id, b.version AS from_version, a.version AS to_version, row_number() OVER (PARTITION BY m.file_id ORDER BY s.o, field) AS step_no, s.action AS action, field, s.source AS source, s.target AS target
FROM moves m JOIN pairs p USING (file_id) JOIN of_file a ON a.file_id = m.file_id JOIN of_file b ON b.file_id = p.prev""",
    "p1_cmap": _conformed("CMAP"),
    "p1_xmap": _conformed("XMAP"),
    "p2_found": P2,
    "p2_periods": f"SELECT 'cmap' AS parent_table, 'xmap' AS child_table, side, reason, period, count(*) AS n_refs FROM ({P2}) GROUP BY ALL",
    "p3_found": P3,
    "p4_found": _F + "SELECT DISTINCT file_id, line_no, reason FROM judged WHERE reason IS NOT NULL",
    "p4_valid": _F + f"SELECT file_id, line_no, {_TYPED} FROM judged WHERE reason IS NULL",
}
