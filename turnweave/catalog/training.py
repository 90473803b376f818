"""Preparation of training rows."""

from pyspark.sql import functions as F

from turnweave.catalog import fixtures as fx
from turnweave.catalog import stubs
from turnweave.catalog.registry import query
from turnweave.functions import tokens
from turnweave.operators import ids, training
from turnweave.operators.tokenize import BatchTokenizer, with_labels, with_token_ids
from turnweave.session import materialize

LIMIT = 100


@query(
    f"""SELECT conv_id, turn, role, text FROM conversations ORDER BY conv_id, turn LIMIT {LIMIT}"""
)
def limit_examples(spark, sf_dir):
    return ids.first_rows(fx.turns(spark, sf_dir), LIMIT, "conv_id", "turn")


SQL_IDS = """SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS id
FROM conversations WHERE role = 'user'"""


def _numbered(spark, sf_dir):
    users = fx.turns(spark, sf_dir).where("role = 'user'")
    return ids.dense_ids(users, "conv_id", "turn")


@query(SQL_IDS)
def row_ids(spark, sf_dir):
    return _numbered(spark, sf_dir)


@query(f"SELECT conv_id, turn, id, id // 64 AS batch, id % 64 // 16 AS mini_batch FROM ({SQL_IDS})")
def batches(spark, sf_dir):
    return ids.with_batches(_numbered(spark, sf_dir), 64, 16)


@query(
    f"""SELECT e::INT AS epoch, id // 64 AS batch, count(*) AS n_rows, min(id) AS first_id
FROM ({SQL_IDS}), range(1, 4) r(e) GROUP BY e, id // 64"""
)
def epochs(spark, sf_dir):
    repeated = ids.with_epochs(ids.with_batches(_numbered(spark, sf_dir)), 3)
    return repeated.groupBy("epoch", "batch").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("first_id")
    )


@query(
    """SELECT count(*) AS n_rows, CAST(ceil(count(*) / 16.0) AS BIGINT) AS steps
FROM conversations WHERE role = 'assistant'"""
)
def steps_per_epoch(spark, sf_dir):
    answers = fx.turns(spark, sf_dir).where("role = 'assistant'")
    return ids.steps_per_epoch(answers, micro_batch_size=2, accumulation=8)


@query(
    """SELECT conv_id, turn,
  CASE WHEN CAST('0x' || substr(md5(CAST(conv_id AS VARCHAR)), 1, 8) AS BIGINT) < 0.02 * 4294967296
    THEN 'validation' ELSE 'train' END AS split
FROM conversations"""
)
def val_split(spark, sf_dir):
    return training.with_split(fx.turns(spark, sf_dir), "conv_id").select("conv_id", "turn", "split")


@query(
    r"""SELECT doc_id, n_tokens, n_tokens <= 2048 AS fits FROM (
  SELECT doc_id, len(regexp_extract_all(text, '\S+'))::BIGINT AS n_tokens FROM documents)"""
)
def seq_len_gate(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    return training.with_length(documents, "text", 2048).drop("text")


@query(
    r"""SELECT conv_id, turn, len(w) > 64 AS truncated, array_to_string(w[1:64], ' ') AS capped
FROM (SELECT conv_id, turn, regexp_extract_all(completion, '\S+') AS w FROM ("""
    + fx.SQL_COMPLETIONS
    + "))"
)
def completion_cap(spark, sf_dir):
    split = fx.completions(spark, sf_dir).withColumn("words", tokens.words(F.col("completion")))
    return training.with_capped(split, "words", 64).select(
        "conv_id", "turn", "truncated", F.array_join("words", " ").alias("capped")
    )


# Small packs and shards, so that the test tables fill several of them.
PACK, SHARD_ROWS = 2048, 64


def sql_packed(key: str) -> str:
    """Packing of the chats' lengths under a key made of ``conv_id``."""
    lengths = rf"""SELECT {key} AS k, sum(len(regexp_extract_all(text, '\S+')))::BIGINT AS n_tokens
      FROM conversations GROUP BY conv_id"""
    return f"""WITH RECURSIVE lengths AS ({lengths}),
rows_ AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY k) AS n FROM (
  SELECT k, n_tokens, CAST('0x' || substr(md5(CAST(k AS VARCHAR)), 1, 8) AS BIGINT)
    % (SELECT greatest(1, (count(*) + {SHARD_ROWS} - 1) // {SHARD_ROWS}) FROM lengths) AS shard FROM lengths)),
walk AS (
  SELECT k, n_tokens, shard, n, 0::BIGINT AS pack, 0::BIGINT AS pos, 0::BIGINT AS "offset"
  FROM rows_ WHERE n = 1
  UNION ALL
  SELECT r.k, r.n_tokens, r.shard, r.n,
    CASE WHEN w."offset" + w.n_tokens + r.n_tokens > {PACK} THEN w.pack + 1 ELSE w.pack END,
    CASE WHEN w."offset" + w.n_tokens + r.n_tokens > {PACK} THEN 0 ELSE w.pos + 1 END,
    CASE WHEN w."offset" + w.n_tokens + r.n_tokens > {PACK} THEN 0 ELSE w."offset" + w.n_tokens END
  FROM walk w JOIN rows_ r ON r.shard = w.shard AND r.n = w.n + 1)
"""


# Keys far apart, and keys that are strings.
SPARSE, NAMED = "conv_id * 1000003", "'chat-' || CAST(conv_id AS VARCHAR)"


def _packed(spark, sf_dir, key):
    lengths = fx.turns(spark, sf_dir).groupBy("conv_id").agg(
        F.sum(tokens.word_count(F.col("text"))).alias("n_tokens")
    )
    keyed = lengths.select(key.alias("k"), "n_tokens")
    return training.pack_sequences(keyed, "k", sequence_len=PACK, shard_rows=SHARD_ROWS)


def _sparse():
    return F.col("conv_id") * 1000003


def _sql_walk(key):
    return f"""{sql_packed(key)} SELECT k, n_tokens, shard, pack, pos, "offset", n_tokens <= {PACK} AS fits
FROM walk"""


@query(_sql_walk("conv_id"))
def sample_packing(spark, sf_dir):
    return _packed(spark, sf_dir, F.col("conv_id"))


@query(_sql_walk(SPARSE))
def sample_packing_sparse(spark, sf_dir):
    return _packed(spark, sf_dir, _sparse())


@query(_sql_walk(NAMED))
def sample_packing_named(spark, sf_dir):
    return _packed(spark, sf_dir, F.concat(F.lit("chat-"), F.col("conv_id").cast("string")))


@query(
    f"""{sql_packed(SPARSE)} SELECT shard, pack, count(*) AS n_sequences, sum(n_tokens)::BIGINT AS used,
  ({PACK} - sum(n_tokens))::BIGINT AS pad, round(sum(n_tokens) / {float(PACK)}::DOUBLE, 6) AS fill
FROM walk WHERE n_tokens <= {PACK} GROUP BY shard, pack"""
)
def pack_padding(spark, sf_dir):
    padded = training.pack_padding(_packed(spark, sf_dir, _sparse()), sequence_len=PACK)
    return padded.withColumn("fill", F.round("fill", 6))


CHUNKS = BatchTokenizer("chunks", stubs.chunk_tokenizer)


@query(
    """SELECT doc_id, n_tokens, n_tokens <= 512 AS fits FROM (
  SELECT doc_id, (length(coalesce(text, '')) + 2) // 3 AS n_tokens FROM documents)"""
)
def token_gate(spark, sf_dir):
    """The length gate with a tokenizer that works on batches."""
    documents = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    return training.with_length(documents, "text", 512, CHUNKS).drop("text")


@query(
    f"""SELECT conv_id, turn, len(ids) > 64 AS truncated, array_to_string(ids[1:64], ' ') AS capped
FROM (SELECT conv_id, turn, list_transform(range(0, length(completion), 3), lambda i: unicode(substr(completion, CAST(i + 1 AS INT), 1))) AS ids
  FROM ({fx.SQL_COMPLETIONS}))"""
)
def token_cap(spark, sf_dir):
    """Ids of a batch tokenizer, cut to a limit."""
    split = with_token_ids(fx.completions(spark, sf_dir), "completion", CHUNKS)
    return training.with_capped(split, "token_ids", 64).select("conv_id", "turn", "truncated", F.array_join("token_ids", " ").alias("capped"))


@query(
    f"""{sql_packed("conv_id").replace("len(regexp_extract_all(text, '\\S+'))", "(length(text) + 2) // 3")}
SELECT k, n_tokens, shard, pack, pos, "offset", n_tokens <= {PACK} AS fits FROM walk"""
)
def token_packing(spark, sf_dir):
    """Packs of sequences whose lengths a batch tokenizer counts."""
    lengths = fx.turns(spark, sf_dir).groupBy(F.col("conv_id").alias("k")).agg(F.sum(CHUNKS(F.col("text"))).alias("n_tokens"))
    return training.pack_sequences(lengths, "k", sequence_len=PACK, shard_rows=SHARD_ROWS)


@query(
    """WITH said AS (SELECT conv_id, turn, role, text, '<|im_start|>' || role || chr(10) AS pre, '<|im_end|>' || chr(10) AS post FROM conversations),
placed AS (SELECT *, coalesce(sum(length(pre || text || post)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p FROM said),
chats AS (SELECT conv_id, string_agg(pre || text || post, '' ORDER BY turn) AS text,
  list({'b': p + length(pre), 'e': p + length(pre || text || post) - 1}) FILTER (role = 'assistant') AS spans FROM placed GROUP BY conv_id),
marked AS (SELECT conv_id, list_transform(range(0, length(text), 3), lambda i: CASE
  WHEN len(list_filter(coalesce(spans, []), lambda s: i >= s.b AND least(i + 3, length(text)) <= s.e)) > 0 THEN unicode(substr(text, CAST(i + 1 AS INT), 1)) ELSE -100 END) AS labels FROM chats)
SELECT conv_id, len(labels) AS n_tokens, len(list_filter(labels, lambda x: x <> -100)) AS n_trained, array_to_string(labels, ' ') AS labels FROM marked"""
)
def token_labels(spark, sf_dir):
    """Labels of whole chats: token ids of the assistant's words, and no label elsewhere."""
    labelled = with_labels(fx.chats(spark, sf_dir), CHUNKS)
    trained = F.size(F.filter("labels", lambda x: x != -100)).cast("bigint")
    return labelled.select(
        "conv_id", F.size("token_ids").cast("bigint").alias("n_tokens"), trained.alias("n_trained"), F.array_join("labels", " ").alias("labels")
    )


SHARD = f"""CAST('0x' || substr(md5(CAST(k AS VARCHAR)), 1, 8) AS BIGINT)
    % (SELECT greatest(1, (count(*) + {SHARD_ROWS} - 1) // {SHARD_ROWS}) FROM lengths)"""


@query(
    rf"""WITH lengths AS (SELECT conv_id AS k, sum(len(regexp_extract_all(text, '\S+')))::BIGINT AS n_tokens FROM conversations GROUP BY conv_id)
SELECT {SHARD} AS shard, count(*) AS n_sequences, CAST(sum(n_tokens) AS BIGINT) AS n_tokens,
  count(*) FILTER (n_tokens > {PACK}) AS n_too_long, 0::BIGINT AS n_overfull, true AS no_more_packs, true AS dense
FROM lengths GROUP BY shard"""
)
def best_fit_packing(spark, sf_dir):
    """Best fit against next fit, shard by shard: nothing is lost, no pack overflows, and there are no more packs."""
    lengths = materialize(
        fx.turns(spark, sf_dir).groupBy(F.col("conv_id").alias("k")).agg(F.sum(tokens.word_count(F.col("text"))).alias("n_tokens")), "lengths"
    )

    def packs(fit):
        return training.pack_sequences(lengths, "k", sequence_len=PACK, shard_rows=SHARD_ROWS, fit=fit)

    best = materialize(packs("best"), "best-fit")
    filled = best.groupBy("shard", "pack").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("used"), F.max(F.col("offset") + F.col("n_tokens")).alias("end"), F.max("pos").alias("last"), F.bool_and("fits").alias("fits")
    )
    # Without gaps the last sequence of a pack ends where the pack's tokens do.
    shards = filled.groupBy("shard").agg(
        F.sum("n").alias("n_sequences"),
        F.sum("used").alias("n_tokens"),
        F.count_if(~F.col("fits")).alias("n_too_long"),
        F.count_if(F.col("fits") & (F.col("used") > PACK)).alias("n_overfull"),
        F.count(F.lit(1)).alias("n_packs"),
        F.bool_and((F.col("end") == F.col("used")) & (F.col("last") == F.col("n") - 1)).alias("dense"),
    )
    others = packs("next").groupBy("shard").agg(F.countDistinct("pack").alias("n_other"))
    return shards.join(others, "shard").select(
        "shard", "n_sequences", "n_tokens", "n_too_long", "n_overfull", (F.col("n_packs") <= F.col("n_other")).alias("no_more_packs"), "dense"
    )


@query(
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT))
  <= round_even(0.05 * (SELECT count(*) FROM documents), 0) THEN 'validation' ELSE 'train' END AS split FROM documents"""
)
def exact_val_split(spark, sf_dir):
    """A split of exactly one in twenty, whatever the number of rows."""
    return training.with_exact_split(fx.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.05)


def _sql_permuted(source: str) -> str:
    """``(conv_id, turn, id, epoch, p)`` with ``p`` permuted once, from the same rows; four rounds, one subquery each."""
    steps = f"(SELECT * EXCLUDE (p), p // c AS l, p % c AS r FROM ({source}))"
    for step in range(ids.SHUFFLE_ROUNDS):
        fixed, moved, size = ("l", "r", "c") if step % 2 else ("r", "l", "a")
        digest = f"CAST('0x' || substr(md5('7|' || epoch || '|{step}|' || {fixed}), 1, 8) AS BIGINT)"
        steps = f"(SELECT * REPLACE (({moved} + {digest}) % {size} AS {moved}) FROM {steps})"
    return f"SELECT * EXCLUDE (l, r), l * c + r AS p FROM {steps}"


@query(
    f"""WITH RECURSIVE sized AS (SELECT n, a, (n + a - 1) // a AS c FROM (SELECT n, greatest(1, CAST(floor(sqrt(n)) AS BIGINT)) AS a FROM (SELECT count(*) AS n FROM ({SQL_IDS})))),
start AS (SELECT conv_id, turn, id, CAST(e AS INT) AS epoch, n, a, c, id AS p FROM ({SQL_IDS}), range(1, 4) r(e), sized),
walk AS ({_sql_permuted("SELECT * FROM start")} UNION ALL {_sql_permuted("SELECT * FROM walk WHERE p >= n")})
SELECT conv_id, turn, epoch, p AS place, p // 64 AS batch FROM walk WHERE p < n"""
)
def epoch_order(spark, sf_dir):
    """Batches of three epochs, each in an order of its own."""
    numbered, n = ids.dealt_by_rows(_numbered(spark, sf_dir))
    ordered = ids.with_epoch_order(ids.with_epochs(numbered, 3), n, seed=7)
    return ids.with_batches(ordered, 64, 16, row="place").select("conv_id", "turn", "epoch", "place", "batch")
