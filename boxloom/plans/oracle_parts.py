"""SQL shared by several checks: clipped boxes, overlaps, rounds of one-to-one matching, outcomes."""

from __future__ import annotations

AREA = "(({p}x2 - {p}x1) * ({p}y2 - {p}y1))"
INTER = "(greatest(0.0, least({a}x2, {b}x2) - greatest({a}x1, {b}x1)) * greatest(0.0, least({a}y2, {b}y2) - greatest({a}y1, {b}y1)))"


def iou_sql(a: str = "a.", b: str = "b.") -> str:
    shared = INTER.format(a=a, b=b)
    return f"({shared} / ({AREA.format(p=a)} + {AREA.format(p=b)} - {shared}))"


def size_sql(area: str) -> str:
    return f"CASE WHEN {area} < 1024 THEN 'small' WHEN {area} < 9216 THEN 'medium' ELSE 'large' END"


BAND = (
    "CASE WHEN score IS NULL THEN 'none' WHEN score >= 0.75 THEN '[0.75,1.00]' WHEN score >= 0.5 THEN '[0.50,0.75)' "
    "WHEN score >= 0.25 THEN '[0.25,0.50)' WHEN score >= 0 THEN '[0.00,0.25)' ELSE 'none' END"
)


def rounds(pairs: str, keys: str, left: str, right: str, order_l: str, order_r: str, prefix: str, n: int = 4) -> dict[str, str]:
    """Views `prefix` (matched pairs) and `prefix_left` (pairs left over, to be empty).

    In each round the pairs that are first for both ends are taken and their ends leave.
    """
    views = {}
    live = pairs
    for i in range(n):
        views[f"{prefix}_t{i}"] = (
            f"SELECT * EXCLUDE (rl, rr) FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, {left} ORDER BY {order_l}) AS rl, "
            f"row_number() OVER (PARTITION BY {keys}, {right} ORDER BY {order_r}) AS rr FROM {live}) z WHERE rl = 1 AND rr = 1"
        )
        views[f"{prefix}_l{i}"] = (
            f"SELECT * FROM {live} WHERE ({keys}, {left}) NOT IN (SELECT ({keys}, {left}) FROM {prefix}_t{i}) "
            f"AND ({keys}, {right}) NOT IN (SELECT ({keys}, {right}) FROM {prefix}_t{i})"
        )
        live = f"{prefix}_l{i}"
    views[prefix] = " UNION ALL ".join(f"SELECT * FROM {prefix}_t{i}" for i in range(n))
    views[f"{prefix}_left"] = f"SELECT * FROM {live}"
    return views


def greedy(pairs: str, keys: str, left: str, right: str, prefix: str, n: int = 4) -> dict[str, str]:
    order = f"iou DESC, {left}, {right}"
    return rounds(pairs, keys, left, right, order, order, prefix, n)


def suppression(source: str, prefix: str, n: int = 4) -> dict[str, str]:
    """View `prefix`: boxes kept at IoU 0.5. A live box without a better live neighbour is kept, then its
    neighbours leave; `prefix_open` holds what `n` rounds leave undecided (to be empty).
    """
    views = {f"{prefix}_better": f"""
        SELECT a.det_id AS loser, b.det_id AS winner, {iou_sql()} AS iou
        FROM {source} a JOIN {source} b ON a.image_id = b.image_id AND a.class_id = b.class_id AND a.det_id <> b.det_id
         AND (b.score > a.score OR (b.score = a.score AND b.det_id < a.det_id))
         AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2
        WHERE {iou_sql()} >= 0.5"""}
    live, edges = f"(SELECT det_id FROM {source})", f"{prefix}_better"
    for i in range(n):
        views[f"{prefix}_keep{i}"] = f"SELECT det_id FROM {live} v WHERE det_id NOT IN (SELECT loser FROM {edges})"
        views[f"{prefix}_gone{i}"] = f"SELECT DISTINCT loser AS det_id FROM {edges} WHERE winner IN (SELECT det_id FROM {prefix}_keep{i})"
        views[f"{prefix}_live{i}"] = f"""SELECT det_id FROM {live} v WHERE det_id NOT IN (SELECT det_id FROM {prefix}_keep{i})
            AND det_id NOT IN (SELECT det_id FROM {prefix}_gone{i})"""
        views[f"{prefix}_edge{i}"] = f"""SELECT * FROM {edges} WHERE loser NOT IN (SELECT det_id FROM {prefix}_gone{i})
            AND winner NOT IN (SELECT det_id FROM {prefix}_gone{i})"""
        live, edges = f"{prefix}_live{i}", f"{prefix}_edge{i}"
    kept = " UNION ALL ".join(f"SELECT det_id FROM {prefix}_keep{i}" for i in range(n))
    views[prefix] = f"SELECT * FROM {source} WHERE det_id IN ({kept})"
    views[f"{prefix}_open"] = f"SELECT * FROM {live}"
    return views


def clip_sql(source: str, extra: str) -> str:
    return f"""
        SELECT * FROM (
            SELECT {extra}, width, height, least(greatest(x1, 0.0), width) AS x1, least(greatest(y1, 0.0), height) AS y1,
                   least(greatest(x2, 0.0), width) AS x2, least(greatest(y2, 0.0), height) AS y2
            FROM {source}) clipped WHERE x2 > x1 AND y2 > y1"""


def scored_sql(source: str) -> str:
    """Boxes less than half in the ignore region of their camera: two rectangles, moved down by the camera's order."""
    share = f"({INTER.format(a='', b='p')} + {INTER.format(a='', b='q')}) / {AREA.format(p='')}"
    return f"""
        SELECT * EXCLUDE (px1, py1, px2, py2, qx1, qy1, qx2, qy2) FROM (
            SELECT *, 0.0 AS px1, 700.0 + 20 * (image_id % 6) AS py1, 600.0 AS px2, 1080.0 AS py2,
                   600.0 AS qx1, 850.0 + 20 * (image_id % 6) AS qy1, 1920.0 AS qx2, 1080.0 AS qy2 FROM {source}) r WHERE {share} < 0.5"""


LEVELS = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]

ORACLE_VIEWS: dict[str, str] = {
    "o_levels": "SELECT * FROM (VALUES " + ", ".join(f"(CAST({x} AS DOUBLE))" for x in LEVELS) + ") v(level)",
    "o_det": clip_sql("det", "det_id, image_id, class_id, score, camera_id"),
    "o_det_b": clip_sql("det_b", "det_id, image_id, class_id, score"),
    "o_truth": clip_sql("truth", "annotation_id, image_id, class_id, occluded, truncated"),
    "o_pred": scored_sql("o_det"),
    "o_true": scored_sql("o_truth"),
    "o_pairs": f"""
        SELECT * FROM (SELECT a.image_id, a.class_id, a.det_id, b.annotation_id, a.score, {iou_sql()} AS iou
        FROM o_pred a JOIN o_true b ON a.image_id = b.image_id AND a.class_id = b.class_id
         AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2) p WHERE iou >= 0.5""",
    **greedy("o_pairs", "image_id, class_id", "det_id", "annotation_id", "o_match"),
    "o_outcomes": f"""
        SELECT coalesce(p.image_id, t.image_id) AS image_id, coalesce(p.class_id, t.class_id) AS class_id, p.det_id, t.annotation_id,
               p.score, p.iou,
               CASE WHEN p.det_id IS NULL THEN 'FN' WHEN t.annotation_id IS NULL THEN 'FP' ELSE 'TP' END AS outcome,
               {size_sql("coalesce(t.area, p.area)")} AS size_bucket, {BAND.replace("score", "p.score")} AS score_band,
               t.occluded, t.truncated
        FROM (SELECT d.image_id, d.class_id, d.det_id, d.score, {AREA.format(p="d.")} AS area, m.annotation_id, m.iou
              FROM o_pred d LEFT JOIN o_match m ON d.det_id = m.det_id) p
        FULL JOIN (SELECT *, {AREA.format(p="")} AS area FROM o_true) t ON p.annotation_id = t.annotation_id""",
    # COCO: predictions by score take the free truth with the largest IoU, per level
    "o_coco_pairs": "SELECT p.*, l.level FROM o_pairs p JOIN o_levels l ON p.iou >= l.level",
    **rounds(
        "o_coco_pairs", "image_id, class_id, level", "det_id", "annotation_id",
        "iou DESC, annotation_id", "score DESC, det_id", "o_coco_match", 4,
    ),
    "o_scored": """
        SELECT d.image_id, d.class_id, d.det_id, d.score, l.level, m.annotation_id IS NOT NULL AS tp
        FROM o_pred d CROSS JOIN o_levels l
        LEFT JOIN o_coco_match m ON d.det_id = m.det_id AND m.level = l.level""",
    "o_truth_counts": "SELECT class_id, count(*) AS n_truth FROM o_true GROUP BY class_id",
    "o_cum": """
        SELECT class_id, level, det_id, score, tp,
               CAST(sum(CASE WHEN tp THEN 1 ELSE 0 END) OVER w AS BIGINT) AS cum_tp,
               CAST(sum(CASE WHEN tp THEN 0 ELSE 1 END) OVER w AS BIGINT) AS cum_fp
        FROM o_scored WINDOW w AS (PARTITION BY class_id, level ORDER BY score DESC, det_id ROWS UNBOUNDED PRECEDING)""",
    "o_curve": """
        SELECT c.class_id, c.level, c.det_id, c.cum_tp, t.n_truth, CAST(c.cum_tp AS DOUBLE)/(c.cum_tp + c.cum_fp) AS precision,
               CAST(c.cum_tp AS DOUBLE)/t.n_truth AS recall
        FROM o_cum c JOIN o_truth_counts t ON c.class_id = t.class_id""",
    "o_ap": """
        SELECT class_id, level, sum(best)/101.0 AS ap FROM (
            SELECT k.class_id, k.level, s.j, coalesce(max(c.precision), 0.0) AS best
            FROM (SELECT DISTINCT class_id, level FROM o_curve) k CROSS JOIN (SELECT unnest(range(0, 101)) AS j) s
            LEFT JOIN (SELECT class_id, level, cum_tp, n_truth, max(precision) AS precision FROM o_curve GROUP BY ALL) c
              ON c.class_id = k.class_id AND c.level = k.level AND s.j * c.n_truth <= 100 * c.cum_tp
            GROUP BY k.class_id, k.level, s.j) z GROUP BY class_id, level""",
    "o_signs": """SELECT vec_id, bit_or(CASE WHEN p > 0 THEN CAST(1 AS UBIGINT) << CAST(i AS INTEGER) ELSE CAST(0 AS UBIGINT) END) AS h
    FROM (SELECT vec_id, i, sum(CASE WHEN m * m % 1000003 % 2 = 0 THEN v ELSE -v END) AS p
          FROM (SELECT vec_id, i, CAST(v AS DOUBLE) AS v, ((i + 1) * 7919 + j * 104729 + (i + 1) * j * 1299709) % 1000003 AS m
                FROM (SELECT vec_id, CAST(generate_subscripts(embedding, 1) AS BIGINT) AS j, unnest(embedding) AS v FROM vectors) z
                CROSS JOIN (SELECT unnest(range(0, 64)) AS i) r) y GROUP BY vec_id, i) x GROUP BY vec_id""",
    **suppression("o_det", "o_nms"),
    **suppression("o_pred", "o_pnms"),
    "o_seq": "SELECT image_key AS image_id, printf('s%02d', seq_truth) AS sequence_id, CAST(seq_truth AS INTEGER) AS fold_id FROM fx_images",
}
