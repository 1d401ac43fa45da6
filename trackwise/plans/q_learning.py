"""Queries over classes, splits, vectors and fusion (embeddings, labels, documents)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import key_from_name, key_from_regex
from ..operators import embed as E
from ..operators import metrics as M
from ..operators import splits as SP
from ..operators.kinematics import FEATURE_COLUMNS
from ..sources import derived as D
from .catalog import big, inputs, r4, register
from .sqlparts import with_base as with_base_sql

# ---- shared SQL for the derived vector tables ----------------------------------

_MODES = ", ".join(f"'{m}'" for m in D.MODES)
VEC_CTES = f"""
emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings),
img AS (
  SELECT 'trajectory_' || printf('v%06d', vec_id) || '_' ||
         CASE WHEN vec_id % {D.UPPER_MODE_EVERY} = 1 THEN upper(([{_MODES}])[label % 5 + 1])
              ELSE ([{_MODES}])[label % 5 + 1] END AS trajectory_id,
         embedding[1:32] AS embedding
  FROM emb WHERE vec_id % {D.IMAGE_DROP_MOD[0]} <> {D.IMAGE_DROP_MOD[1]}),
txt AS (
  SELECT printf('v%06d', vec_id) AS trajectory_id, embedding[33:64] AS embedding
  FROM emb WHERE vec_id % {D.TEXT_DROP_MOD[0]} <> {D.TEXT_DROP_MOD[1]}),
img_k AS (
  SELECT CASE WHEN regexp_matches(trajectory_id, 'trajectory_(.*)_[a-z]+$')
              THEN regexp_extract(trajectory_id, 'trajectory_(.*)_[a-z]+$', 1) END AS trajectory_id,
         embedding FROM img),
fused AS (
  SELECT i.trajectory_id, list_concat(i.embedding, t.embedding) AS embedding
  FROM img_k i JOIN txt t ON i.trajectory_id = t.trajectory_id),
vlab AS (SELECT printf('v%06d', vec_id) AS trajectory_id, printf('c%d', label) AS label FROM emb),
pred AS (SELECT printf('c%d', label) AS actual, printf('c%d', (label + vec_id % 2) % 10) AS predicted
         FROM emb)
"""


def vsql(body: str, extra: str = "") -> str:
    return "WITH " + VEC_CTES.strip() + ("," + extra if extra else "") + "\n" + body


def _checksum(vec: str) -> str:
    return f"round(list_sum(list_transform({vec}, lambda x, i: CAST(x AS DOUBLE) * i)), 4)"


def checksum(col):
    """Order-sensitive checksum of a vector: sum of x_i * i (i from 1)."""
    return r4(F.aggregate(F.transform(col, lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0),
                          lambda a, b: a + b))


def _pred_df(spark, sf):
    e = inputs(spark, sf).table("embeddings")
    return e.select(F.format_string("c%d", "label").alias("actual"),
                    F.format_string("c%d", (F.col("label") + F.col("vec_id") % 2) % 10).alias("predicted"))


def _vlab(spark, sf):
    return D.derive_vector_labels(inputs(spark, sf).table("embeddings"))


# ---- class statistics -------------------------------------------------------------

@register("label_dist", vsql("SELECT label, CAST(count(*) AS BIGINT) AS n FROM vlab GROUP BY label"))
def q_label_dist(spark, sf):
    return M.label_distribution(_vlab(spark, sf)).select("label", big("n").alias("n"))


@register("class_vocab", vsql("""
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS BIGINT) AS idx
FROM (SELECT DISTINCT label FROM vlab)"""))
def q_class_vocab(spark, sf):
    return M.class_vocab(_vlab(spark, sf)).select("label", big("index").alias("idx"))


@register("label_encode", vsql("""
SELECT v.trajectory_id, v.label, CAST(c.idx AS BIGINT) AS label_index FROM vlab v JOIN
  (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT label FROM vlab)) c
  USING (label)"""))
def q_label_encode(spark, sf):
    v = _vlab(spark, sf)
    return M.encode_labels(v, M.class_vocab(v)).select("trajectory_id", "label",
                                                       big("label_index").alias("label_index"))


@register("confusion", vsql("""
SELECT actual, predicted, CAST(count(*) AS BIGINT) AS n FROM pred GROUP BY actual, predicted"""))
def q_confusion(spark, sf):
    return M.confusion(_pred_df(spark, sf)).select("actual", "predicted", big("n").alias("n"))


@register("accuracy", vsql("""
SELECT round((SELECT avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) FROM pred), 4) AS acc_vectors,
       round((SELECT avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END) FROM labels), 4) AS acc_labels"""))
def q_accuracy(spark, sf):
    a = M.accuracy(_pred_df(spark, sf)).withColumn("m", F.lit("v"))
    lab = inputs(spark, sf).table("labels")
    b = M.accuracy(lab, "quality", "toxic").withColumn("m", F.lit("l"))
    u = a.unionByName(b)
    return u.agg(r4(F.max(F.when(F.col("m") == "v", F.col("accuracy")))).alias("acc_vectors"),
                 r4(F.max(F.when(F.col("m") == "l", F.col("accuracy")))).alias("acc_labels"))


_REPORT_SQL = vsql("""
SELECT name, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1_score, 4) AS f1_score,
       round(support, 4) AS support FROM (
  SELECT name, precision, recall, f1_score, support FROM per
  UNION ALL SELECT 'accuracy', acc, acc, acc, acc FROM tot
  UNION ALL SELECT 'macro avg', mp, mr, mf, n FROM tot
  UNION ALL SELECT 'weighted avg', wp / n, wr / n, wf / n, n FROM tot)""", """
voc AS (SELECT actual AS label FROM pred UNION SELECT predicted FROM pred),
per0 AS (
  SELECT v.label AS name,
         CAST((SELECT count(*) FROM pred WHERE actual = v.label AND predicted = v.label) AS DOUBLE) AS tp,
         CAST((SELECT count(*) FROM pred WHERE actual = v.label) AS DOUBLE) AS support,
         CAST((SELECT count(*) FROM pred WHERE predicted = v.label) AS DOUBLE) AS npred
  FROM voc v),
per1 AS (
  SELECT *, CASE WHEN npred = 0 THEN 0.0 ELSE tp / npred END AS precision,
         CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM per0),
per AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                 ELSE 2 * precision * recall / (precision + recall) END AS f1_score FROM per1),
tot AS (
  SELECT sum(tp) / sum(support) AS acc, avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf,
         sum(support) AS n, sum(precision * support) AS wp, sum(recall * support) AS wr,
         sum(f1_score * support) AS wf FROM per)""")


@register("class_report", _REPORT_SQL)
def q_class_report(spark, sf):
    r = M.class_report(_pred_df(spark, sf))
    return r.select("name", *[r4(c).alias(c) for c in ("precision", "recall", "f1_score", "support")])


# ---- splits ----------------------------------------------------------------------------

def _split_sql(seed: int, body: str) -> str:
    return vsql(body, f"""
rk AS (
  SELECT trajectory_id, label,
         row_number() OVER (PARTITION BY label ORDER BY md5(trajectory_id || '|{seed}'), trajectory_id) - 1 AS r,
         count(*) OVER (PARTITION BY label) AS n
  FROM vlab)""")


def _deal_sql(name: str, source: str, size: str, fraction: float) -> str:
    """``ceil(fraction * rows)`` dealt to the classes by largest remainder, a training row kept."""
    goal = f"CAST(ceil(sum({size}) OVER () * CAST({fraction} AS DOUBLE)) AS BIGINT)"
    return f"""
{name}_0 AS (SELECT *, {goal} AS goal, CAST(sum({size}) OVER () AS BIGINT) AS total FROM {source}),
{name}_1 AS (SELECT *, least(goal * {size} // total, {size} - 1) AS base, goal * {size} % total AS remainder FROM {name}_0),
{name}_2 AS (SELECT *, goal - CAST(sum(base) OVER () AS BIGINT) AS over_, row_number() OVER (
      PARTITION BY base < {size} - 1 ORDER BY remainder DESC, label) AS turn FROM {name}_1),
{name} AS (SELECT * EXCLUDE (goal, total, base, remainder, over_, turn),
      base + CASE WHEN base < {size} - 1 AND turn <= over_ THEN 1 ELSE 0 END AS {name}_n FROM {name}_2)"""


_CLASS_SIZES = "class_sizes AS (SELECT label, count(*) AS n FROM vlab GROUP BY label)"


@register("strat_split", _split_sql(42, f"""
, {_CLASS_SIZES}, {_deal_sql("test", "class_sizes", "n", 0.2)}
SELECT trajectory_id, rk.label, CASE WHEN r < test_n THEN 'test' ELSE 'train' END AS split
FROM rk JOIN test USING (label)"""))
def q_strat_split(spark, sf):
    return SP.stratified_split(_vlab(spark, sf), "label", "trajectory_id", 0.2, 42) \
             .select("trajectory_id", "label", "split")


@register("split_3way", _split_sql(3407, f"""
, {_CLASS_SIZES}, {_deal_sql("test", "class_sizes", "n", 0.15)},
rest AS (SELECT label, test_n, n - test_n AS m FROM test), {_deal_sql("val", "rest", "m", 0.176)}
SELECT trajectory_id, rk.label, CASE WHEN r < test_n THEN 'test' WHEN r < test_n + val_n THEN 'val' ELSE 'train' END AS split
FROM rk JOIN val USING (label)"""))
def q_split_3way(spark, sf):
    return SP.three_way_split(_vlab(spark, sf), "label", "trajectory_id", 0.15, 0.176, 3407) \
             .select("trajectory_id", "label", "split")


@register("kfold", _split_sql(42, """
SELECT trajectory_id, label, CAST(r % 3 AS BIGINT) AS fold FROM rk"""))
def q_kfold(spark, sf):
    return SP.kfold(_vlab(spark, sf), "label", "trajectory_id", 3, 42) \
             .select("trajectory_id", "label", big("fold").alias("fold"))


def _std_sql() -> str:
    feats = FEATURE_COLUMNS
    from .q_trajectory import _FEAT_CTES, _FEATURE_EXPR
    fe = ", ".join(f"CASE WHEN z THEN CAST(0.0 AS DOUBLE) ELSE coalesce({e}, CAST(0.0 AS DOUBLE)) END AS {n}"
                   for e, n in zip(_FEATURE_EXPR, feats))
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in feats)
    out = ", ".join(f"round(CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END, 4)"
                    f" AS {c}" for c in feats)
    return with_base_sql(f"SELECT unique_id, {out} FROM fv, st", _FEAT_CTES + f""",
fv AS (SELECT unique_id, label, {fe} FROM feat),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(unique_id || '|42'), unique_id) - 1 AS r FROM fv),
class_sizes AS (SELECT label, count(*) AS n FROM fv GROUP BY label), {_deal_sql("test", "class_sizes", "n", 0.2)},
st AS (SELECT {stats} FROM rk JOIN test USING (label) WHERE r >= test_n)""")


@register("standardise", _std_sql())
def q_standardise(spark, sf):
    f = inputs(spark, sf).features
    s = SP.stratified_split(f, "label", "unique_id", 0.2, 42)
    stats = SP.fit_standardiser(s.where(F.col("split") == "train"), FEATURE_COLUMNS)
    z = SP.apply_standardiser(s, stats)
    return z.select("unique_id", *[r4(c).alias(c) for c in FEATURE_COLUMNS])


def classical_test_sql(body: str) -> str:
    """``body`` over ``tested`` (unique_id, label: the test rows of the classical
    split), ``learned`` (the other rows) and ``classes`` (c)."""
    from .q_trajectory import _FEAT_CTES
    return with_base_sql(body, _FEAT_CTES + f""",
fl AS (SELECT unique_id, label FROM feat),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(unique_id || '|42'), unique_id) - 1 AS r FROM fl),
class_sizes AS (SELECT label, count(*) AS n FROM fl GROUP BY label), {_deal_sql("test", "class_sizes", "n", 0.2)},
tested AS (SELECT unique_id, rk.label FROM rk JOIN test USING (label) WHERE r < test_n),
learned AS (SELECT fl.* FROM fl ANTI JOIN tested USING (unique_id)),
classes AS (SELECT DISTINCT label AS c FROM fl WHERE label IS NOT NULL)""")


def embedding_test_sql(body: str) -> str:
    """The same for the test rows (trajectory_id, label) of the three-way split of
    the fused vectors."""
    return vsql(body, f"""
fl AS (SELECT trajectory_id, l.label FROM fused JOIN vlab l USING (trajectory_id)),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(trajectory_id || '|3407'), trajectory_id) - 1 AS r FROM fl),
class_sizes AS (SELECT label, count(*) AS n FROM fl GROUP BY label), {_deal_sql("test", "class_sizes", "n", 0.15)},
tested AS (SELECT trajectory_id, rk.label FROM rk JOIN test USING (label) WHERE r < test_n),
classes AS (SELECT DISTINCT label AS c FROM fl)""")


# ---- vectors and fusion ----------------------------------------------------------------

def _tables(spark, sf):
    return D.derive_vector_tables(inputs(spark, sf).table("embeddings"))


@register("key_regex", vsql("""
SELECT trajectory_id AS name,
       CASE WHEN regexp_matches(trajectory_id, 'trajectory_(.*)_[a-z]+$')
            THEN regexp_extract(trajectory_id, 'trajectory_(.*)_[a-z]+$', 1) END AS key FROM img"""))
def q_key_regex(spark, sf):
    img, _ = _tables(spark, sf)
    return img.select(F.col("trajectory_id").alias("name"), key_from_regex("trajectory_id").alias("key"))


@register("key_from_name", with_base_sql("""
SELECT name, concat_ws('_', string_split(name, '_')[2], string_split(name, '_')[3],
                       string_split(name, '_')[4]) AS key
FROM (SELECT DISTINCT 'trajectory_' || unique_id || '_' || transport_mode AS name FROM clean)"""))
def q_key_from_name(spark, sf):
    c = inputs(spark, sf).clean
    n = c.select(F.concat(F.lit("trajectory_"), "unique_id", F.lit("_"), "transport_mode").alias("name")) \
         .distinct()
    return n.select("name", key_from_name("name").alias("key"))


@register("fusion_join", vsql(f"""
SELECT trajectory_id, CAST(len(embedding) AS BIGINT) AS dim, {_checksum('embedding')} AS checksum
FROM fused"""))
def q_fusion_join(spark, sf):
    img, txt = _tables(spark, sf)
    f = E.fuse([(img, "image"), (txt, "text")])
    return f.select("trajectory_id", F.size("embedding").cast("bigint").alias("dim"),
                    checksum(F.col("embedding")).alias("checksum"))


@register("late_fusion", vsql(f"""
SELECT f.trajectory_id, l.label, CAST(len(embedding) AS BIGINT) AS dim,
       round(embedding[1], 4) AS first_x, round(embedding[33], 4) AS x33
FROM fused f JOIN vlab l USING (trajectory_id)"""))
def q_late_fusion(spark, sf):
    img, txt = _tables(spark, sf)
    f = E.fuse([(img, "image"), (txt, "text")])
    lab, _ = E.attach_labels(f, _vlab(spark, sf))
    return lab.select("trajectory_id", F.col("true_label").alias("label"),
                      F.size("embedding").cast("bigint").alias("dim"),
                      r4(F.get("embedding", 0)).alias("first_x"), r4(F.get("embedding", 32)).alias("x33"))


@register("vec_concat", vsql(f"""
SELECT trajectory_id, {_checksum('embedding[1:32]')} AS head_sum, {_checksum('embedding[33:64]')} AS tail_sum
FROM fused"""))
def q_vec_concat(spark, sf):
    img, txt = _tables(spark, sf)
    f = E.fuse([(img, "image"), (txt, "text")])
    return f.select("trajectory_id", checksum(F.slice("embedding", 1, 32)).alias("head_sum"),
                    checksum(F.slice("embedding", 33, 32)).alias("tail_sum"))


@register("json_vec", vsql(f"""
SELECT trajectory_id, CAST(len(embedding) AS BIGINT) AS dim, {_checksum('embedding')} AS checksum FROM (
  SELECT printf('v%06d', vec_id) AS trajectory_id,
         list_transform(embedding[33:64], lambda x: CAST(CAST(x AS VARCHAR) AS DOUBLE)) AS embedding
  FROM embeddings WHERE vec_id % {D.TEXT_DROP_MOD[0]} <> {D.TEXT_DROP_MOD[1]})"""))
def q_json_vec(spark, sf):
    _, txt = _tables(spark, sf)
    j = txt.select("trajectory_id", E.vector_to_json("embedding").alias("embedding_json"))
    back = j.select("trajectory_id", E.vector_from_json("embedding_json").alias("embedding"))
    return back.select("trajectory_id", F.size("embedding").cast("bigint").alias("dim"),
                       checksum(F.col("embedding")).alias("checksum"))


@register("to_float32", vsql(f"""
SELECT trajectory_id, {_checksum('CAST(embedding AS FLOAT[])')} AS checksum FROM fused"""))
def q_to_float32(spark, sf):
    img, txt = _tables(spark, sf)
    f = E.fuse([(img, "image"), (txt, "text")])
    return f.select("trajectory_id", checksum(E.to_float32("embedding")).alias("checksum"))


@register("emb_dim", vsql("""
SELECT CAST(min(len(embedding)) AS BIGINT) AS min_dim, CAST(max(len(embedding)) AS BIGINT) AS max_dim,
       CAST(count(*) AS BIGINT) AS n_rows FROM fused"""))
def q_emb_dim(spark, sf):
    img, txt = _tables(spark, sf)
    m = M.embedding_dim(E.fuse([(img, "image"), (txt, "text")]))
    return m.select(big("min_dim").alias("min_dim"), big("max_dim").alias("max_dim"),
                    big("n_rows").alias("n_rows"))


@register("label_join", vsql("""
SELECT trajectory_id, l.label,
       (SELECT CAST(count(*) AS BIGINT) FROM img_k i LEFT JOIN vlab l2 USING (trajectory_id)
        WHERE l2.label IS NULL) AS unlabelled
FROM img_k JOIN vlab l USING (trajectory_id)"""))
def q_label_join(spark, sf):
    img, _ = _tables(spark, sf)
    keyed = E.normalise_key(img, "image")
    lab, missing = E.attach_labels(keyed, _vlab(spark, sf))
    # the count is one row, joined in the plan
    return lab.join(F.broadcast(missing)).select("trajectory_id", F.col("true_label").alias("label"),
                                                 F.coalesce("unlabelled", F.lit(0)).cast("bigint").alias("unlabelled"))


@register("key_to_text", """
SELECT CAST(vec_id AS VARCHAR) AS trajectory_id, CAST(label AS VARCHAR) AS label FROM embeddings""")
def q_key_to_text(spark, sf):
    e = inputs(spark, sf).table("embeddings")
    vec = e.select(F.col("vec_id").alias("trajectory_id"), "embedding")
    lab = e.select(F.col("vec_id").alias("trajectory_id"), F.col("label").cast("string").alias("label"))
    j, _ = E.attach_labels(vec, lab)
    return j.select("trajectory_id", F.col("true_label").alias("label"))


# ---- default embedding providers -------------------------------------------------------

_TEXT_SQL = """
SELECT doc_id, CAST(bucket AS BIGINT) AS bucket, round(cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY doc_id)), 4)
       AS weight FROM (
  SELECT doc_id, CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) % 64 AS bucket, CAST(count(*) AS DOUBLE) AS cnt
  FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS tok FROM documents)
  WHERE length(tok) > 0 GROUP BY 1, 2)"""


@register("embed_text", _TEXT_SQL)
def q_embed_text(spark, sf):
    docs = inputs(spark, sf).table("documents")
    v = E.embed_text(docs, "doc_id", "text", 64)
    s = v.select("doc_id", F.posexplode("embedding").alias("bucket", "w")).where(F.col("w") > 0)
    return s.select("doc_id", big("bucket").alias("bucket"), r4("w").alias("weight"))
