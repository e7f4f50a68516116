import hashlib
import random
import re

import pytest

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def lowered(text):
    return (text or "").translate(LOWER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="session")
def hard_texts():
    """Texts with copies, near copies, odd characters, one very long one, and no text."""
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma,", "delta.", "é", "ß", "漢字", "x1", "don't", "[INST]", "</s>", "\\"]
    vocabulary += [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 90))) for _ in range(40)]
    near = []
    for text in base[:20]:
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        near.append(" ".join(words))
    odd = [None, "", " ", "\n\n", "\x00", "a", "A", "a  b", "  lead", "trail ", "tab\tand\nline", "\x1c\x85 x"]
    odd += ["<|endoftext|> <|startoftext|>", "🙂" * 40, "aaaa" * 50, base[0].upper(), base[1]]
    return base + near + base[:5] + odd + [" ".join(rng.choice(vocabulary) for _ in range(9000))]


@pytest.fixture(scope="session")
def docs(spark, hard_texts):
    rows = [(i * 7 % 1009, t) for i, t in enumerate(hard_texts)] + [(None, "a"), (None, None), (3, "twice"), (3, "twice")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")
