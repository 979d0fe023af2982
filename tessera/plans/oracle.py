"""Equivalent SQL for the named queries, runnable by DuckDB on the driver tables as views.

The SQL states each query the plain way -- all-pairs (band) joins for distances, a self-join of
cells for the 7x7 sums, one CTE pair per farthest-first round, a join for sticky counts -- so it is
an independent check of the Spark plans. Float32 constants are inlined exactly.
"""

from __future__ import annotations

import math

import numpy as np

from tessera.operators.frequency import (
    TAG_RESERVOIR_ACCEPT,
    TAG_RESERVOIR_SLOT,
    TAG_STICKY_ACCEPT,
)
from tessera.plans import catalog as C

# ---- expressions, written out here and not taken from the engine -------------------------------

SQRT8 = 2.0 * math.sqrt(2.0)

SQL_SPLIT_LINES = (
    "CASE WHEN {t} = '' THEN CAST([] AS VARCHAR[]) "
    "WHEN suffix({t}, chr(10)) OR suffix({t}, chr(13)) "
    "THEN string_split_regex({t}, '\\r\\n|\\n|\\r')[1:-2] "
    "ELSE string_split_regex({t}, '\\r\\n|\\n|\\r') END"
)

SQL_SPACE_TOKENS = (
    "CASE WHEN {l} = '' THEN [''] WHEN rtrim({l}, ' ') = '' THEN CAST([] AS VARCHAR[]) "
    "ELSE string_split(rtrim({l}, ' '), ' ') END"
)


def f32(value: float) -> float:
    return float(np.float32(value))


def sql_float(value: float) -> str:
    return f"CAST({f32(value)!r} AS FLOAT)"


def cell_side(d: float) -> float:
    return f32(f32(d) / SQRT8)


def sql_distance(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"CAST(sqrt(pow(CAST({x1} - {x2} AS DOUBLE), 2) + pow(CAST({y1} - {y2} AS DOUBLE), 2)) AS FLOAT)"


def sql_uniform(pos: str, tag: str, seed: int) -> str:
    """The first 32 bits of md5('tag:seed:pos') over 2^32."""
    return f"(CAST(('0x' || left(md5('{tag}:{seed}:' || {pos}::VARCHAR), 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


# ---- inputs ----------------------------------------------------------------------------------

PTS = "pts AS (SELECT vec_id AS id, embedding[1] AS x, embedding[2] AS y, CAST(1 AS BIGINT) AS w FROM embeddings)"
ORD = (
    "pts AS (SELECT o_orderkey AS id, CAST(o_totalprice / 1000.0 AS FLOAT) AS x, "
    "CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS FLOAT) AS y, "
    "CAST(1 AS BIGINT) AS w FROM orders)"
)
LI = (
    "pts AS (SELECT 0 AS id, x, y, CAST(count(*) AS BIGINT) AS w FROM (SELECT "
    "CAST(l_extendedprice / 1000.0 AS FLOAT) AS x, CAST(l_quantity AS FLOAT) AS y FROM lineitem) GROUP BY x, y)"
)
DOCS = (
    "lines AS (SELECT doc_id, CAST(unnest(range(len(arr))) AS INTEGER) AS line_no, unnest(arr) AS line "
    f"FROM (SELECT doc_id, {SQL_SPLIT_LINES.format(t='text')} AS arr FROM documents)), "
    f"toks AS (SELECT doc_id, line_no, unnest({SQL_SPACE_TOKENS.format(l='line')}) AS word FROM lines)"
)
ITEMS = (
    "params AS (SELECT p_total, CAST(p_total AS BIGINT) AS p_n, CAST(75.0 / p_total AS FLOAT) AS p_phi, "
    "CAST(15.0 / p_total AS FLOAT) AS p_eps, CAST(0.1 AS FLOAT) AS p_delta "
    "FROM (SELECT CAST(count(*) AS DOUBLE) AS p_total FROM events)), "
    "derived AS (SELECT *, CAST(ceil(CAST(1 AS FLOAT) / p_phi) AS BIGINT) AS p_m, "
    "CAST(CAST(ln(CAST(1 AS FLOAT) / (p_delta * p_phi)) AS FLOAT) / p_eps AS FLOAT) AS p_r, "
    "p_phi * CAST(p_n AS FLOAT) AS p_thr_true, "
    "CAST(trunc((p_phi - p_eps) * CAST(p_n AS FLOAT)) AS BIGINT) AS p_thr_sticky FROM params), "
    "prefix AS (SELECT event_id AS pos, user_id AS item FROM events, derived WHERE event_id < p_n)"
)


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


# ---- approximate grid ------------------------------------------------------------------------


def _cells(d: float | str) -> str:
    lam = sql_float(cell_side(d)) if not isinstance(d, str) else d
    return (
        f"cells AS (SELECT id, x, y, w, CAST(floor(CAST(CAST(x AS DOUBLE) / CAST({lam} AS DOUBLE) AS FLOAT)) AS BIGINT) AS i, "
        f"CAST(floor(CAST(CAST(y AS DOUBLE) / CAST({lam} AS DOUBLE) AS FLOAT)) AS BIGINT) AS j FROM pts), "
        "cc AS (SELECT i, j, CAST(sum(w) AS BIGINT) AS n FROM cells GROUP BY i, j), "
        "regions AS (SELECT a.i, a.j, a.n, "
        "CAST(sum(CASE WHEN abs(b.i - a.i) <= 1 AND abs(b.j - a.j) <= 1 THEN b.n ELSE 0 END) AS BIGINT) AS n3, "
        "CAST(sum(b.n) AS BIGINT) AS n7 FROM cc a JOIN cc b "
        "ON b.i BETWEEN a.i - 3 AND a.i + 3 AND b.j BETWEEN a.j - 3 AND a.j + 3 GROUP BY a.i, a.j, a.n)"
    )


def _approx_counts(m: int) -> str:
    return (
        f"SELECT CAST(coalesce(sum(CASE WHEN n7 <= {m} THEN n END), 0) AS BIGINT) AS sure_outliers, "
        f"CAST(coalesce(sum(CASE WHEN n3 <= {m} AND n7 > {m} THEN n END), 0) AS BIGINT) AS uncertain_points "
        "FROM regions"
    )


# ---- exact balls -----------------------------------------------------------------------------


def _balls(d: float) -> str:
    band = 2.0 * f32(d)
    dist = sql_distance("a.x", "a.y", "b.x", "b.y")
    return (
        "balls AS (SELECT a.id, a.x, a.y, a.w, CAST(sum(b.w) AS BIGINT) AS ball FROM pts a JOIN pts b "
        f"ON b.x BETWEEN a.x - {band!r} AND a.x + {band!r} AND b.y BETWEEN a.y - {band!r} AND a.y + {band!r} "
        f"WHERE {dist} <= {sql_float(d)} GROUP BY a.id, a.x, a.y, a.w)"
    )


# ---- farthest-first --------------------------------------------------------------------------


def _fft(src: str, k: int, order: str, part: str | None, name: str) -> str:
    """CTEs ``{name}_c0 .. {name}_c{k-1}`` and ``{name}`` (part, pick, id, x, y)."""
    by = f"PARTITION BY part " if part else ""
    part_sel = f"{part} AS part" if part else "0 AS part"
    ctes = [
        f"{name}_p AS (SELECT {part_sel}, * FROM {src})",
        f"{name}_c0 AS (SELECT part, 0 AS pick, id, x, y FROM (SELECT *, row_number() OVER ({by}ORDER BY {order}) AS rn "
        f"FROM {name}_p) WHERE rn = 1)",
    ]
    prev_d = None
    for r in range(1, k):
        dist = sql_distance("q.x", "q.y", "c.x", "c.y")
        if prev_d is None:
            ctes.append(
                f"{name}_d{r} AS (SELECT q.*, {dist} AS d FROM {name}_p q JOIN {name}_c{r - 1} c USING (part))"
            )
        else:
            ctes.append(
                f"{name}_d{r} AS (SELECT q.* REPLACE (least(q.d, {dist}) AS d) FROM {prev_d} q "
                f"JOIN {name}_c{r - 1} c USING (part))"
            )
        prev_d = f"{name}_d{r}"
        ctes.append(
            f"{name}_c{r} AS (SELECT part, {r} AS pick, id, x, y FROM (SELECT *, row_number() OVER ({by}ORDER BY d DESC, {order}) AS rn "
            f"FROM {prev_d} WHERE d > 0) WHERE rn = 1)"
        )
    union = " UNION ALL ".join(f"SELECT * FROM {name}_c{r}" for r in range(k))
    ctes.append(f"{name} AS ({union})")
    return ", ".join(ctes)


def _kc_centers() -> str:
    part = f"(CAST(('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) % {C.KC_L})"
    core = _fft("pts", C.KC_K, "id", part, "core")
    cen = _fft("(SELECT part AS cpart, pick AS cpick, id, x, y FROM core)", C.KC_K, "cpart, cpick", None, "cen")
    near = (
        "ncd AS (SELECT p.id, min(" + sql_distance("p.x", "p.y", "c.x", "c.y") + ") AS d FROM pts p, cen c GROUP BY p.id)"
    )
    return _with(PTS, core, cen, near)


def _one_pass_coreset() -> str:
    block = f"(CAST(('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) % {C.KC_L * C.KC_BLOCKS})"
    blocks = _fft("pts", C.KC_K, "id, x, y", block, "blk")
    merged = _fft("(SELECT part AS block, pick AS bpick, id, x, y FROM blk)", C.KC_K, "block, bpick", f"(block % {C.KC_L})", "mrg")
    return _with(PTS, blocks, merged) + "SELECT CAST(part AS BIGINT) AS part, CAST(pick AS INTEGER) AS pick, id, x, y FROM mrg"


def _radius_outliers() -> str:
    lam = f"CAST(CAST((SELECT max(d) FROM ncd) AS DOUBLE) / {SQRT8!r} AS FLOAT)"
    return (
        _kc_centers().rstrip() + ", " + _cells(lam) + " "
        + "SELECT (SELECT max(d) FROM ncd) AS radius, * FROM (" + _approx_counts(C.PTS_M) + ")"
    )


# ---- items -----------------------------------------------------------------------------------


def _items(seed: int) -> str:
    u1 = sql_uniform("pos", TAG_RESERVOIR_ACCEPT, seed)
    u2 = sql_uniform("pos", TAG_RESERVOIR_SLOT, seed)
    us = sql_uniform("pos", TAG_STICKY_ACCEPT, seed)
    return _with(
        ITEMS,
        "hist AS (SELECT item, count(*) AS n FROM prefix GROUP BY item)",
        "truefreq AS (SELECT item, n FROM hist, derived WHERE CAST(n AS FLOAT) >= p_thr_true)",
        f"acc AS (SELECT CAST(CASE WHEN pos < p_m THEN pos ELSE floor({u2} * p_m) END AS BIGINT) AS slot, pos, item "
        f"FROM prefix, derived WHERE pos < p_m OR {u1} * CAST(pos AS DOUBLE) <= CAST(p_m AS DOUBLE))",
        "reservoir AS (SELECT slot, max(pos) AS pos, max_by(item, pos) AS item FROM acc GROUP BY slot)",
        f"firsts AS (SELECT item, min(pos) AS first FROM prefix, derived "
        f"WHERE {us} <= CAST(p_r AS DOUBLE) / CAST(p_n AS DOUBLE) GROUP BY item)",
        "sticky AS (SELECT p.item, count(*) AS n FROM prefix p JOIN firsts f ON p.item = f.item AND p.pos >= f.first "
        "GROUP BY p.item)",
        "stickyfreq AS (SELECT item FROM sticky, derived WHERE n >= p_thr_sticky)",
    )


def _flag(est: str) -> str:
    return (
        f"SELECT e.item, CASE WHEN t.item IS NOT NULL THEN '+' ELSE '-' END AS flag FROM ({est}) e "
        "LEFT JOIN truefreq t ON e.item = t.item"
    )


def oracle_sql() -> dict[str, str]:
    it = _items(C.ITEMS_SEED)
    approx = _with(PTS, _cells(C.PTS_D))
    balls = _with(PTS, _balls(C.PTS_D))
    m = C.PTS_M
    sql = {
        "points_parse": (
            "WITH lines AS (SELECT p_partkey AS key, concat_ws(',', p_size || '.' || (p_partkey % 97), "
            "' ' || ((p_partkey * 7) % 1000) || '.25', p_brand) AS value FROM part) "
            "SELECT key AS id, CAST(trim(string_split(value, ',')[1]) AS FLOAT) AS x, "
            "CAST(trim(string_split(value, ',')[2]) AS FLOAT) AS y FROM lines"
        ),
        "point_count": _with(PTS) + "SELECT count(*) AS n_points FROM pts",
        "grid_cells": approx + "SELECT id, i, j FROM cells",
        "cell_counts": approx + "SELECT i, j, n FROM cc",
        "cell_regions": approx + "SELECT i, j, n, n3, n7 FROM regions",
        "approx_outlier_counts": approx + _approx_counts(m),
        "point_labels": approx
        + f"SELECT id, CASE WHEN n7 <= {m} THEN 'sure' WHEN n3 <= {m} THEN 'uncertain' ELSE 'inlier' END AS label "
        "FROM cells JOIN regions USING (i, j)",
        "smallest_cells_topk": approx + f"SELECT i, j, n FROM cc ORDER BY n, i, j LIMIT {C.PTS_TOPK}",
        "ball_counts": balls + "SELECT id, x, y, ball FROM balls",
        "ball_counts_adaptive": balls + "SELECT id, x, y, ball FROM balls",
        "exact_outliers": balls + f"SELECT id, x, y, ball FROM balls WHERE ball <= {m}",
        "exact_outlier_count": balls + f"SELECT count(*) AS n_outliers FROM balls WHERE ball <= {m}",
        "exact_outliers_topk": balls
        + f"SELECT id, x, y, ball FROM balls WHERE ball <= {m} ORDER BY ball, id LIMIT {C.PTS_TOPK}",
        "approx_outlier_counts_ord": _with(ORD, _cells(C.ORD_D)) + _approx_counts(C.ORD_M),
        "exact_outliers_ord": _with(ORD, _balls(C.ORD_D)) + f"SELECT id, x, y, ball FROM balls WHERE ball <= {C.ORD_M}",
        "approx_outlier_counts_li": _with(LI, _cells(C.LI_D)) + _approx_counts(C.LI_M),
        "exact_outliers_li": _with(LI, _balls(C.LI_D)) + f"SELECT x, y, w, ball FROM balls WHERE ball <= {C.LI_M}",
        "kcenter_coreset": _kc_centers() + "SELECT CAST(part AS BIGINT) AS part, CAST(pick AS INTEGER) AS pick, id, x, y FROM core",
        "kcenter_coreset_one_pass": _one_pass_coreset(),
        "kcenter_centers": _kc_centers() + "SELECT CAST(pick AS INTEGER) AS pick, id, x, y FROM cen",
        "kcenter_global": _with(PTS, _fft("pts", C.KC_K, "id", None, "g"))
        + "SELECT CAST(pick AS INTEGER) AS pick, id, x, y FROM g",
        "nearest_center_distance": _kc_centers() + "SELECT id, d FROM ncd",
        "kcenter_radius": _kc_centers() + "SELECT max(d) AS radius FROM ncd",
        "radius_then_outliers": _radius_outliers(),
        "doc_lines": _with(DOCS) + "SELECT doc_id, line_no, line FROM lines",
        "doc_count": _with(DOCS) + "SELECT count(*) AS n_docs FROM lines",
        "word_counts": _with(DOCS) + "SELECT word, count(*) AS n FROM toks GROUP BY word",
        "doc_word_counts": _with(DOCS) + "SELECT doc_id, line_no, word, count(*) AS n FROM toks GROUP BY doc_id, line_no, word",
        "word_counts_salted": _with(DOCS) + "SELECT word, count(*) AS n FROM toks GROUP BY word",
        "word_counts_salted_pairs": _with(DOCS) + "SELECT word, count(*) AS n FROM toks GROUP BY word",
        "word_counts_partitioned": _with(DOCS) + "SELECT word, count(*) AS n FROM toks GROUP BY word",
        "distinct_word_count": _with(DOCS) + "SELECT count(DISTINCT word) AS n_words FROM toks",
        "avg_distinct_word_length": _with(DOCS)
        + "SELECT n_words, total_length, CAST(total_length AS DOUBLE) / CAST(n_words AS DOUBLE) AS avg_length FROM ("
        "SELECT count(*) AS n_words, CAST(coalesce(sum(length(word) + "
        "length(regexp_replace(word, '[^\\x{10000}-\\x{10FFFF}]', '', 'g'))), 0) AS BIGINT) AS total_length "
        "FROM (SELECT DISTINCT word FROM toks))",
        "items_parse": "SELECT event_id AS pos, CAST(trim(CAST(user_id AS VARCHAR)) AS BIGINT) AS item FROM events",
        "stream_prefix": "SELECT event_id AS pos, user_id AS item FROM events WHERE event_id < (SELECT count(*) FROM events) * 4 // 5",
        "distinct_items": it + "SELECT DISTINCT item FROM prefix",
        "distinct_items_summary": it
        + "SELECT CAST(count(*) AS BIGINT) AS n_items, count(DISTINCT item) AS n_distinct, "
        "CAST(greatest(coalesce(max(item), 0), 0) AS BIGINT) AS largest_item FROM prefix",
        "item_histogram": it + "SELECT item, n FROM hist",
        "frequent_items": it + "SELECT item, n FROM truefreq",
        "reservoir_sample": it + "SELECT slot, pos, item FROM reservoir",
        "reservoir_frequent_items": it + _flag("SELECT DISTINCT item FROM reservoir"),
        "sticky_counts": it + "SELECT item, n FROM sticky",
        "sticky_frequent_items": it + _flag("SELECT item FROM stickyfreq"),
        "frequent_items_summary": it
        + "SELECT 'exact' AS method, count(*) AS n_held, (SELECT count(*) FROM truefreq) AS n_estimated FROM hist "
        "UNION ALL SELECT 'reservoir', count(*), count(DISTINCT item) FROM reservoir "
        "UNION ALL SELECT 'sticky', count(*), (SELECT count(*) FROM stickyfreq) FROM sticky",
    }
    return sql
