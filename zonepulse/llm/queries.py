"""The registered queries ``op<N>_<name>`` and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import text_of
from .registry import documents, register

TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op1_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op1(spark, sf_dir):
    from .exact_dedup import exact_dedup
    return exact_dedup(documents(spark, sf_dir), extra={"text_sha256": F.sha2(text_of(), 256)})


@register("op3_near_dedup", r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') AS w FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    sized AS (SELECT * FROM shingles JOIN sizes USING (doc_id)),
    links AS (
      SELECT a.doc_id AS x, b.doc_id AS y FROM sized a JOIN sized b
        ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach AS (
      SELECT DISTINCT x, x AS y FROM both_ways
      UNION
      SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
    lows AS (SELECT x, min(y) AS low FROM reach GROUP BY x)
    SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(low, d.doc_id) AS component_id,
           coalesce(low, d.doc_id) = d.doc_id AS kept
    FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lows ON d.doc_id = lows.x""")
def op3(spark, sf_dir):
    from .near_dedup import near_duplicates
    return near_duplicates(documents(spark, sf_dir), width=2, percent=80)


@register("op4_mix_sources", r"""
    WITH d AS (
      SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
             CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15)) AS BIGINT) AS place
      FROM documents),
    s AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
      FROM d GROUP BY source),
    o AS (
      SELECT *, row_number() OVER r AS k, sum(3 * source_size) OVER r AS held, sum(weight) OVER r AS w_held,
             sum(source_size) OVER () AS total, sum(weight) OVER () AS w_all
      FROM s WINDOW r AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST)),
    steps AS (
      SELECT k, total - (held - 3 * source_size) AS rest, w_all - (w_held - weight) AS w_rest,
             weight * (total - (held - 3 * source_size)) <= 3 * source_size * (w_all - (w_held - weight)) AS stop
      FROM o),
    fix AS (SELECT k, rest, w_rest FROM steps WHERE stop ORDER BY k LIMIT 1),
    goal AS (
      SELECT o.source, o.source_size,
             CASE WHEN o.k < fix.k THEN CAST(3 * o.source_size AS DOUBLE)
                  ELSE CAST(o.weight AS DOUBLE) * CAST(fix.rest AS DOUBLE) / CAST(fix.w_rest AS DOUBLE) END AS target
      FROM o, fix),
    plan AS (
      SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS whole
      FROM goal),
    cells AS (SELECT source, place, sum(size) AS words FROM d WHERE size > 0 GROUP BY source, place),
    run AS (
      SELECT c.source, c.place, c.words, p.target - p.whole * p.source_size AS budget,
             sum(c.words) OVER (PARTITION BY c.source ORDER BY c.place) - c.words AS before
      FROM cells c JOIN plan p ON c.source IS NOT DISTINCT FROM p.source WHERE p.whole < 3),
    more AS (
      SELECT source, place FROM run
      WHERE before + words <= budget
         OR (before <= budget AND before + words > budget AND before + words - budget < budget - before))
    SELECT d.doc_id, d.size, p.source_size, p.target,
           CAST(d.size * (p.whole + CASE WHEN m.place IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken
    FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
    LEFT JOIN more m ON d.source IS NOT DISTINCT FROM m.source AND d.place = m.place""")
def op4(spark, sf_dir):
    from .mixing import mix
    return mix(documents(spark, sf_dir)).drop("copies")


@register("op2_pii")
def op2(spark, sf_dir):
    from .pii import KINDS, find_pii
    from .spans import label
    found = find_pii(documents(spark, sf_dir))
    base = F.concat(*[label(F.col(k), k) for k in KINDS])
    more = F.transform("added", lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string")))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, more), ",").alias("spans"),
        F.size("added").cast("long").alias("n_added"))


@register("op5_fingerprint")
def op5(spark, sf_dir):
    from .fingerprint import as_text, fingerprint_pairs
    return fingerprint_pairs(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("sk")).alias("fingerprint"),
        as_text(F.col("edited_sk")).alias("edited_fingerprint"), "near_edited", "near_next", "kept_in_edited")


@register("op6_quality")
def op6(spark, sf_dir):
    from .quality import classify
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


@register("op7_line_dedup", r"""
    WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, unnest(ls) AS t, generate_subscripts(ls, 1) - 1 AS i FROM d),
    w AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto
          FROM (SELECT *, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n FROM l)),
    runs AS (
      SELECT a.doc_id, a.i AS s, min(b.i) + 1 AS e FROM w a JOIN w b
        ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= 50 GROUP BY a.doc_id, a.i
      UNION
      SELECT a.doc_id, max(b.i) AS s, a.i + 1 AS e FROM w a JOIN w b
        ON a.doc_id = b.doc_id AND b.i <= a.i AND a.upto - b.upto + b.n >= 50 GROUP BY a.doc_id, a.i),
    named AS (SELECT r.doc_id, s, e, string_agg(t, chr(10) ORDER BY i) AS run
              FROM runs r JOIN l ON r.doc_id = l.doc_id AND i >= s AND i < e GROUP BY r.doc_id, s, e),
    placed AS (SELECT *, first_value(doc_id) OVER g AS fd, first_value(s) OVER g AS fs
               FROM named WINDOW g AS (PARTITION BY run ORDER BY doc_id, s)),
    cuts AS (SELECT doc_id, CASE WHEN fd = doc_id THEN greatest(s, fs + e - s) ELSE s END AS s, e
             FROM placed WHERE NOT (fd = doc_id AND fs = s)),
    gone AS (SELECT DISTINCT l.doc_id, l.i FROM l JOIN cuts c ON l.doc_id = c.doc_id AND l.i >= c.s AND l.i < c.e),
    islands AS (SELECT doc_id, min(i) AS a, max(i) + 1 AS b, count(*) AS n
                FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM gone) GROUP BY doc_id, g),
    marks AS (SELECT doc_id, string_agg(a || ':' || b, ',' ORDER BY a) AS runs, CAST(sum(n) AS BIGINT) AS n_deleted
              FROM islands GROUP BY doc_id),
    left_over AS (SELECT l.doc_id, string_agg(t, chr(10) ORDER BY i) AS kept
                  FROM l WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = l.doc_id AND g.i = l.i) GROUP BY l.doc_id)
    SELECT d.doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
           coalesce(runs, '') AS runs, sha256(coalesce(kept, '')) AS text_sha256
    FROM d LEFT JOIN marks USING (doc_id) LEFT JOIN left_over USING (doc_id)""")
def op7(spark, sf_dir):
    from .line_dedup import dedup_lines
    return dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_deleted", "runs", F.sha2(text_of(), 256).alias("text_sha256"))


@register("op8_secrets")
def op8(spark, sf_dir):
    from .secrets import KINDS, joined, scan_secrets
    found = scan_secrets(documents(spark, sf_dir))
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(KINDS), 256).alias("base_sha256"),
                        joined((*KINDS, "entropy")).alias("spans"))


@register("op9_sentencepiece")
def op9(spark, sf_dir):
    from .piece_codec import encode_digest
    return encode_digest(documents(spark, sf_dir), tokenizer_path())


@register("op10_shard")
def op10(spark, sf_dir):
    from .sharding import shard
    return shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


UNITS = "regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]')"


@register("op11_fill_in_middle", f"""
    WITH u AS (SELECT doc_id, coalesce(text, '') AS t, {UNITS} AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    c AS (SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, {", ".join(f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))} FROM u),
    p AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c),
    x AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
                 coalesce(array_to_string(u[b + 1:n], ''), '') AS suf FROM p)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                  ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(t) AS restored_sha256 FROM x""")
def op11(spark, sf_dir):
    from .fim import fill_in_middle, restored
    return fill_in_middle(documents(spark, sf_dir)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


def _leaf_sql(text: str) -> str:
    parts = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({p}) AS VARCHAR) || ':' || {p}, '-')" for p in parts) + ")"


CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda s, b: list_reduce(list_prepend(xor(s, b), [CAST(0 AS BIGINT) FOR z IN range(8)]), lambda y, z: xor(y // 2, 3988292384 * (y % 2)))))"""
LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _tree_sql(name: str, base: str) -> str:
    """Nodes of every level: tree, lvl, i, h and m, the nodes of the level."""
    return f"""{name} AS (
      SELECT tree, CAST(0 AS BIGINT) AS lvl, i, h, m FROM {base}
      UNION ALL
      SELECT tree, lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), any_value((m + 15) // 16)
      FROM {name} WHERE m > 1 GROUP BY tree, lvl, i // 16)"""


def _steps_sql(rows: str, tree: str, part: int) -> str:
    """The siblings before and after a row's own node, level by level."""
    return f"""SELECT r.rid, {part} AS part, n.lvl, string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < r.i >> (4 * n.lvl)) AS pre,
             string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > r.i >> (4 * n.lvl)) AS post
      FROM {rows} r JOIN {tree} n ON n.tree = r.tree AND n.m > 1 AND n.i // 16 = (r.i >> (4 * n.lvl)) // 16 GROUP BY r.rid, n.lvl"""


@register("op12_manifest", f"""
    WITH RECURSIVE raw AS (
      SELECT doc_id, coalesce('s' || source, '') AS tree, {_leaf_sql("text")} AS h,
             CASE WHEN {CRC32_SQL} % 5 = 0 THEN {_leaf_sql(LOWER_SQL)} END AS shown FROM documents),
    leaves AS (SELECT *, row_number() OVER () AS rid, CAST(row_number() OVER g - 1 AS BIGINT) AS i, CAST(count(*) OVER (PARTITION BY tree) AS BIGINT) AS m
               FROM raw WINDOW g AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h)),
    {_tree_sql("trees", "leaves")},
    subs AS (SELECT '' AS tree, tree AS source, h, CAST(row_number() OVER (ORDER BY tree) - 1 AS BIGINT) AS i, CAST(count(*) OVER () AS BIGINT) AS m
             FROM trees WHERE m = 1),
    {_tree_sql("tops", "subs")},
    at_top AS (SELECT l.rid, s.tree, s.i FROM leaves l JOIN subs s ON l.tree = s.source),
    steps AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY part, lvl) AS step FROM (
      {_steps_sql("leaves", "trees", 0)} UNION ALL {_steps_sql("at_top", "tops", 1)})),
    proofs AS (SELECT rid, sha256(string_agg(coalesce(pre, '') || coalesce(post, ''), '' ORDER BY step)) AS proof, max(step) AS n FROM steps GROUP BY rid),
    folds AS (
      SELECT rid, CAST(0 AS BIGINT) AS step, coalesce(shown, h) AS h FROM leaves
      UNION ALL
      SELECT f.rid, s.step, sha256(coalesce(s.pre, '') || f.h || coalesce(s.post, '')) FROM folds f JOIN steps s ON s.rid = f.rid AND s.step = f.step + 1)
    SELECT l.doc_id, l.h AS leaf, s.h AS subroot, t.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
    FROM leaves l JOIN subs s ON l.tree = s.source JOIN (SELECT h FROM tops WHERE m = 1) t ON true
    LEFT JOIN proofs p ON p.rid = l.rid JOIN folds f ON f.rid = l.rid AND f.step = coalesce(p.n, 0)""")
def op12(spark, sf_dir):
    from .merkle import lower_ascii, manifest
    return manifest(documents(spark, sf_dir), lower_ascii(F.col("text")), F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


@register("op13_neighbours")
def op13(spark, sf_dir):
    from .neighbours import nearest
    return nearest(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
