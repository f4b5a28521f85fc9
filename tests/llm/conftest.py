import random

import pytest

WORDS = [a + b for a in "the of and to in is that".split() for b in ("", "re", "on", "ing")]


def prose(rng, n):
    """Words of a small stock, in lines of about a dozen."""
    words = [rng.choice(WORDS) + rng.choice(["", "", ".", "x", "ly", "é"]) for _ in range(n)]
    return "\n".join(" ".join(words[k : k + 12]) for k in range(0, n, 12))


def edited(rng, text, n):
    """The text with ``n`` words replaced."""
    lines = [line.split(" ") for line in text.split("\n")]
    for _ in range(n):
        line = rng.choice(lines)
        line[rng.randrange(len(line))] = f"w{rng.randrange(10**6)}"
    return "\n".join(" ".join(line) for line in lines)


@pytest.fixture(scope="session")
def corpus_rows():
    """(doc_id, text): prose, exact and near copies, shared passages and odd texts."""
    rng = random.Random(5)
    base = [prose(rng, rng.randrange(20, 160)) for _ in range(25)]
    passage = prose(rng, 60)
    texts = list(base)
    for k in range(60):
        texts.append(edited(rng, base[k % 6], rng.randrange(0, 5)))
    for _ in range(30):
        texts.append(edited(rng, base[7], rng.randrange(1, 8)))
    texts += [prose(rng, 30) + "\n" + passage for _ in range(12)]
    texts += [base[3]] * 6 + [base[3].upper()]
    texts += [None, "", "   \n\t ", "one", "one two three", "one two three", "a\n\nb", "\n", "É " * 40]
    texts.append(" ".join(f"w{rng.randrange(3000)}" for _ in range(30_000)))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def corpus_docs(spark, corpus_rows):
    """The rows as documents, with columns whose names operators use themselves."""
    rows = [(d, t, "en", f"s{d % 3}", len(t or ""), d, "x") for d, t in corpus_rows]
    names = "doc_id long, text string, lang string, source string, n_chars long, n long, token string"
    return spark.createDataFrame(rows, names).repartition(5, "doc_id").cache()
