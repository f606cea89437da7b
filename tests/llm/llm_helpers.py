"""Small inputs with the odd cases every operator must stand."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_texts():
    rng = random.Random(5)
    vocab = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "Eta", "theta", "iota", "kappa"]
    words = lambda n: " ".join(rng.choice(vocab) + str(rng.randrange(40)) for _ in range(n))
    base = words(60)
    return [
        None, "", " ", "\n\n \t", "a", "one two", "  lead and trail  ", base, base, base.replace(" ", "\n"), base.upper(), base + " tail",
        words(4000), "x" * 3000, "日本語のテキスト。" * 50, "a b c \x1c d", "tok\0en", "🙂🙃 " * 30, "Der " * 200,
        "line\nline\nline\nother words here", "  \n  a  \n b", "'s don't I'll we've <|endoftext|> </s>", words(30) + "\n" + words(30),
    ]


def odd_docs(spark):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(odd_texts())]
    rows += [rows[7], rows[7], (None, "no id at all", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The same rows with further columns whose names the operators might use themselves."""
    from pyspark.sql import functions as F

    names = ["n", "w", "kept", "score", "ids", "_key", "_row", "_flag", "_again", "_rank", "node", "root", "a", "shard", "template", "bucket", "text_sha256"]
    return df.select("*", *[F.lit("clash").alias(n) for n in names], F.create_map(F.lit("k"), F.lit(1)).alias("some_map"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
