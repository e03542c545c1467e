"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import public_tokenizers

from loadkit.llm import chat, collocations, decontamination, jaccard, mixing, neighbours, quality, repeats, runs, sharding, simhash, tokens, toxicity
from loadkit.llm.common import table

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@query(
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0) x),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS (
        SELECT x.a, x.b FROM (
            SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS both FROM shingles p JOIN shingles q ON p.s = q.s AND p.doc_id <> q.doc_id
            GROUP BY p.doc_id, q.doc_id) x
        JOIN sizes m ON m.doc_id = x.a JOIN sizes n ON n.doc_id = x.b WHERE 180 * x.both >= 80 * (m.n + n.n)),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, (SELECT min(b) FROM reach r WHERE r.a = d.doc_id) AS component_id,
           (SELECT count(*) FROM links l WHERE l.a = d.doc_id) AS n_links
    FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
    """
)
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


@query()
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


@query()
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


_ESCAPED = "replace(replace(replace({0}, '\\', '\\b'), '<', '\\l'), '|', '\\p')"


def _chat_log(rows: DataFrame) -> DataFrame:
    """The log that a chat leaves behind which ends in these rows (conv_id, turn, again, role, text).

    An assistant's first answer is broken off, and another message begun, when
    it is asked to answer again; its answers stream in two pieces. All others
    send a draft, and edit it to what the row says.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    begin, rest = F.substr("text", F.lit(1), half), F.substr("text", half + 1)

    def event(step: int, kind: str, text: Column, aside: int = 0) -> Column:
        message = F.struct("turn", "again", F.lit(aside).alias("aside"))
        seq = F.struct("turn", "again", F.lit(step).alias("step"))
        return F.struct(message.alias("message"), seq.alias("seq"), F.lit(kind).alias("kind"), "role", text.alias("text"))

    answered = F.array(
        event(0, "delta", rest),
        event(1, "set", begin, aside=1),
        event(2, "regenerate", F.lit(None).cast("string")),
        event(3, "delta", begin),
        event(4, "delta", rest),
    )
    sent = F.array(event(0, "set", begin), event(1, "edit", F.col("text")))
    return rows.select("conv_id", F.inline(F.when(F.col("role") == "assistant", answered).otherwise(sent)))


@query(
    f"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(13 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id
    """
)
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    both = F.inline(F.array(*[F.struct(F.lit(-1).alias("conv_id"), F.lit(t).alias("turn"), F.lit(r).alias("role"), F.lit(control).alias("text")) for t, r in enumerate(("user", "assistant"))]))
    rows = given.unionByName(spark.range(1).select(both))
    # each row is a message of its own, also where a turn's number is there again
    again = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    events = _chat_log(rows.withColumn("again", again))
    rendered = chat.render(chat.reconstruct(events, "conv_id", "message", "seq", "kind", "role", "text"))
    read = rendered.select(
        F.col("conv").alias("conv_id"),
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    shown = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(shown.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.search_table(rows, rows.where("vec_id % 100 = 0"))


@query()
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query()
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.graded(docs, model).select("row.doc_id", "expected_grade", "tail", F.col("selected").cast("int").alias("predicted"))


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, lexicon).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query()
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def _with_runs(docs: DataFrame) -> DataFrame:
    """Writes a run into about every tenth text: from some word on, a period of original words over and over."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size("_words"), F.floor(F.col("_h") / 10)
    start, period = F.col("_a"), F.col("_p")
    word = lambda w, i: F.when(i < start, w).otherwise(F.get("_words", (start + (i - start) % period).cast("int")))
    chosen = docs.select("doc_id", "text", h.alias("_h")).withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    chosen = chosen.withColumn("_a", F.when(n > 0, g % n)).withColumn("_p", F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8)))
    return chosen.select("doc_id", F.when(n > 0, F.array_join(F.transform("_words", word), " ")).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse_runs(_with_runs(table(spark, sf_dir, "documents")))
    longest = F.element_at(F.array_sort("runs", lambda x, y: F.when(_before(x, y), -1).when(_before(y, x), 1).otherwise(0)), 1)
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    return found.withColumn("longest", F.when(F.size("runs") > 0, longest)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.floor(F.lit(1000) * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _before(x, y):
    """Whether a run comes before another: longer, then further to the front, then of a shorter period."""
    return F.struct(-x["length"], x["start"], x["period"]) < F.struct(-y["length"], y["start"], y["period"])


@query(
    r"""
    WITH p AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
        FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents) d),
    g1 AS (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM p) o GROUP BY ALL),
    g2 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f
           FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM p) o GROUP BY ALL HAVING count(*) >= 10),
    g3 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f
           FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM p) o GROUP BY ALL HAVING count(*) >= 10),
    cuts AS (
        SELECT g2.lang, x || ' ' || y AS phrase, g2.f AS a, 1 AS k, p.f AS l, q.f AS r
        FROM g2 JOIN g1 p USING (lang, x) JOIN (SELECT lang, x AS y, f FROM g1) q USING (lang, y)
        WHERE NOT EXISTS (SELECT 1 FROM g3 WHERE g3.lang = g2.lang AND 100 * g3.f >= 50 * g2.f
                          AND (g3.x = g2.x AND g3.y = g2.y OR g3.y = g2.x AND g3.z = g2.y))
        UNION ALL
        SELECT g3.lang, concat_ws(' ', x, y, z), g3.f, 1, p.f, q.f
        FROM g3 JOIN g1 p USING (lang, x) JOIN (SELECT lang, x AS y, y AS z, f FROM g2) q USING (lang, y, z)
        UNION ALL
        SELECT g3.lang, concat_ws(' ', x, y, z), g3.f, 2, p.f, q.f
        FROM g3 JOIN g2 p USING (lang, x, y) JOIN (SELECT lang, x AS z, f FROM g1) q USING (lang, z)),
    scored AS (
        SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
    lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM lowest JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g1 GROUP BY lang) t USING (lang)
    QUALIFY rank <= 2000
    """
)
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
