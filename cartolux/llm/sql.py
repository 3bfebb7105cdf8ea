"""SQL of the queries p5 to p9 that SQL can express."""

_GROUPS = """
WITH RECURSIVE links AS (
  SELECT DISTINCT a, b FROM (
    SELECT id1 AS a, id2 AS b FROM edges UNION ALL SELECT id2, id1 FROM edges
    UNION ALL SELECT QryContigID, RefContigID_x FROM glues UNION ALL SELECT RefContigID_x, QryContigID FROM glues
    UNION ALL SELECT QryContigID, RefContigID_y FROM glues UNION ALL SELECT RefContigID_y, QryContigID FROM glues)
  WHERE a <> b),
ids AS (
  SELECT DISTINCT id FROM (SELECT id1 AS id FROM edges UNION ALL SELECT id2 FROM edges UNION ALL SELECT QryContigID FROM glues
    UNION ALL SELECT RefContigID_x FROM glues UNION ALL SELECT RefContigID_y FROM glues) WHERE id IS NOT NULL),
reached(id, g) AS (
  SELECT id, id FROM ids
  UNION SELECT l.b, r.g FROM reached r JOIN links l ON l.a = r.id WHERE r.g < l.b),
groups AS (SELECT id AS record_id, min(g) AS group_id FROM reached GROUP BY id)
"""

_VALUES = """
WITH lens AS (SELECT CMapId, max(ContigLength) AS l FROM cmap WHERE ContigLength IS NOT NULL AND isfinite(ContigLength) GROUP BY 1),
labels AS (
  SELECT 'Position' AS measure, map_set, LabelChannel AS label_channel, CAST(min(loaded_at) AS DATE) AS day, Position AS value
  FROM cmap LEFT JOIN lens USING (CMapId)
  WHERE LabelChannel <> 0 AND isfinite(Position) AND Position >= 0
    AND (CASE WHEN isfinite(ContigLength) THEN Position <= ContigLength ELSE l IS NULL OR Position <= l END)
  GROUP BY map_set, CMapId, SiteID, LabelChannel, Position),
lengths AS (
  SELECT 'ContigLength' AS measure, map_set, CAST(NULL AS INTEGER) AS label_channel, CAST(min(loaded_at) AS DATE) AS day,
    max(CASE WHEN isfinite(ContigLength) AND ContigLength > 0 THEN ContigLength END) AS value
  FROM cmap GROUP BY map_set, CMapId),
vals AS (SELECT * FROM labels UNION ALL SELECT * FROM lengths WHERE value IS NOT NULL),
qs(q) AS (VALUES (0.05::DOUBLE), (0.25), (0.5), (0.75), (0.95))
"""


def _exact(keys: str) -> str:
    return _VALUES + f""", ranked AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY value) AS rn, count(*) OVER (PARTITION BY {keys}) AS n FROM vals)
SELECT {keys}, n, q, value FROM ranked, qs WHERE rn = greatest(1, CAST(ceil(q * n) AS BIGINT))"""


ORACLES = {
    "p5_found": _GROUPS + "SELECT record_id, group_id FROM groups",
    "p5_sizes": _GROUPS + "SELECT n_records, count(*) AS n_groups FROM (SELECT count(*) AS n_records FROM groups GROUP BY group_id) GROUP BY 1",
    "p6_daily": _exact("measure, map_set, label_channel, day"),
    "p6_overall": _exact("measure, map_set, label_channel"),
}
