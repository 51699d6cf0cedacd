import random

import pytest


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, source, lang, extra) rows with copies, near copies, shared passages, repeats, nulls, empties and long texts."""
    r = random.Random(11)
    syllables = ["an", "the", "ti", "on", "ing", "ré", "ß", "中", "or", "es"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    prose = lambda n: " ".join(word() + (".\n" if i % 17 == 16 else "") for i in range(n))
    passage, line = prose(60), "one common line of many sites"
    texts = [prose(r.randint(5, 220)) for _ in range(30)]
    texts += [texts[0]] * 12 + [texts[1], texts[1]]
    for base in texts[:6]:
        words = base.split(" ")
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += [prose(30) + " " + passage + " " + prose(20) for _ in range(5)]
    texts += [prose(20) + "\n" + line + "\n" + prose(20) for _ in range(14)]
    texts += [None, "", "   \n\t", "a", "two words", "ab " * 700, "x" * 900, "é" * 300, "<|endoftext|> end", "A B c  D\n" * 9, prose(6000)]
    ids = list(range(3, 3 + 2 * len(texts), 2))
    return [(i, t, None if i % 31 == 0 else f"s{i % 13}", ("en", "fr", None)[i % 3], "clash") for i, t in zip(ids, texts, strict=True)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string, source string, lang string, spans string").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, spans string")


@pytest.fixture(scope="session")
def odd(spark):
    """Null and repeated ids, repeated rows."""
    rows = [(None, "the same words stand here again", None, None, ""), (5, "the same words stand here again", "a", "en", ""), (5, "the same words stand here again", "a", "en", ""), (5, "other words", "b", None, ""), (7, None, None, None, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, spans string")
