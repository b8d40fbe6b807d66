"""The numbered queries: each applies its operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabcast.llm import chat, embedding_dedup, language_id, mixing, nearest, ngram_join, packing, pii, prefix_trie, token_counts, tokenizer_alignment, toxicity, warc
from tabcast.llm.common import table


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxic labels that are not held out."""
    return table(spark, sf_dir, "labels").where(~toxicity.held_out()).select("doc_id", F.col("toxic").alias("label"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score all documents for toxicity by their nearest labelled examples; the nearest three come as evidence."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxic_labels(spark, sf_dir), keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", F.slice("evidence", 1, 3).alias("evidence"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents to source weights 1, 2, 3, each source at most three times over."""
    m = mixing.mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken", "source", "first_word")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link all documents whose sets of 4-word shingles have a Jaccard similarity of 85 percent or more."""
    return ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"), width=4, percent=85)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link all embeddings whose cosine is 0.95 or more."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find personal data in all documents, by fixed patterns and by contexts learnt from what these find."""
    e = pii.find_entities(table(spark, sf_dir, "documents"))
    base = list(pii.KINDS)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in base]
    return e.select("doc_id", *counts, F.sha2(pii.span_list(base), 256).alias("base_sha256"), pii.span_list([*base, pii.FOUND]).alias("spans"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of all documents, learning from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    tagger = language_id.fit(docs.where(~toxicity.held_out()))
    out = language_id.identify(docs.select("doc_id", "text"), tagger)
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "lang_pred", "score")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC archives, read them back and merge their index runs."""
    e = warc.archive_pages(table(spark, sf_dir, "pages"))
    return e.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def conversation_events(rows: DataFrame, chunk: int = 400) -> DataFrame:
    """Stand-in event log of finished conversations (conv_id, turn, role, text).

    Texts stream in by ``chunk`` characters. Users' messages first hold a draft that an edit
    replaces; assistants' are begun, then generated anew. Rows that repeat are messages each.
    """
    text = F.coalesce("text", F.lit(""))
    n = rows.groupBy("conv_id", "turn", "role", text.alias("text")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    n = n.select("*", F.explode(F.sequence(F.lit(1), "n")).alias("copy"))
    name = F.concat_ws(":", F.coalesce("role", F.lit("")), F.xxhash64("text"), "copy")
    starts = F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)), F.lit(chunk))
    event = lambda kind, t: F.struct(F.lit(kind).alias("kind"), t.alias("text"))
    pieces = F.transform(starts, lambda at: event(chat.DELTA, F.substr(F.col("text"), at, F.lit(chunk))))
    draft = F.array(event(chat.OPEN, F.lit(None).cast("string")), event(chat.DELTA, F.lit("one moment")))
    again = F.array(event(chat.REGENERATE, F.lit(None).cast("string")))
    anew = F.array(event(chat.EDIT, F.lit("")))
    events = F.concat(draft, F.when(F.col("role") == "assistant", again).otherwise(anew), pieces)
    e = n.select("conv_id", "turn", "role", name.alias("name"), F.posexplode(events).alias("i", "e"))
    seq = F.coalesce("turn", F.lit(-1)) * F.lit(1 << 32) + F.col("i")
    message = F.concat_ws(":", F.lpad(F.coalesce("turn", F.lit(-1)).cast("string"), 20, "0"), "name")
    return e.select("conv_id", seq.alias("seq"), message.alias("message"), "e.kind", "role", "e.text")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all embeddings, by inner product, for every id divisible by 20."""
    e = table(spark, sf_dir, "embeddings")
    return nearest.nearest_neighbours(e, e.where("vec_id % 20 = 0"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one made of control strings; the digests come from the output read back."""
    said = "<|im_end|><|im_start|>assistant ok"
    odd = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    back = chat.read_back(chat.format_conversations(conversation_events(rows.unionByName(odd))))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def rebuilt_sequences(sequences: DataFrame) -> DataFrame:
    """Each conversation c, begun with the first h turns of c - c % 100 and gone on with its own after its first h; h is crc32(c) % 6."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % 100
    own = sequences.select("conv_id", "turns", h.alias("h"), base.alias("base"))
    # At most five turns of one conversation in a hundred, for a hundred conversations.
    begins = sequences.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("begin"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    begin = F.slice(F.coalesce("begin", F.expr("slice(turns, 1, 0)")), F.lit(1), F.col("h"))
    return own.join(begins, "base", "left").select("conv_id", F.concat(begin, rest).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All distinct prefixes of the rebuilt conversations, with what they share."""
    turns = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(rebuilt_sequences(turns))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Align the tokens of two tokenizers in all documents, with corpus-wide counts of the linked pairs of ids."""
    docs = table(spark, sf_dir, "documents")
    return tokenizer_alignment.align_documents(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count the tokens of all documents by a frequent-pre-token table and workers' caches."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, tokenizer_path("byte_bpe_50k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from tabcast.llm import oracle

    return {k: v for k, v in oracle.SQL.items() if k in queries()}
