import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents table from (doc_id, text) or (doc_id, text, lang, source)."""
    def make(rows, extra=False):
        full = [(i, t, *(rest or ("en", "src0")), len(t or "")) for i, t, *rest in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        if extra:  # names that operators use for themselves
            for name in ("key", "h", "n", "size", "bin", "copies", "keep_key", "token", "class", "root", "epoch", "tokens", "domain",
                         "text_hash", "rep_id", "shard", "score", "id"):
                df = df.withColumn(name, df.n_chars * 0 + 7)
        return df
    return make
