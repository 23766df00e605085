"""Small tables with every awkward case: nulls, empty and long texts, ties, clashing columns."""

# names that the operators use inside; results must not depend on a table having them
CLASHES = "row long, digest string, _row string, _key string, fp long, score double, n long, size long"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
CLASH = (7, "d", "r", "k", 1, 0.5, 3, 9)


def documents(spark, rows, partitions=3):
    """``rows`` are (doc_id, text, lang, source)."""
    full = [(i, t, lang, src, None if t is None else len(t), *CLASH) for i, t, lang, src in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.repartition(partitions) if full else df


def plain(spark, texts, partitions=3):
    """Texts with ids from 0."""
    return documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)], partitions)


LONG = " ".join(f"word{i % 977}" for i in range(60_000))
AWKWARD = [None, "", " \n\t ", "a", "A", "ÄA", "äa", LONG, "...", "\x00", "é" * 30, "same text", "Same Text"]
