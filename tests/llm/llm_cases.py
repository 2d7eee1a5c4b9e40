"""Small documents with the awkward cases, and digests."""

import hashlib
import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def corpus(seed=3, size=60):
    """Texts with exact and near copies, shared passages and lines, nulls, empty, long and repetitive ones."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "", ".", "\n", "\t"]) for _ in range(n))
    passages = [prose(60) for _ in range(4)]
    line = "a line that many documents share, number one"
    texts = [None, "", " \n\t", "one", "x " * 700, line]
    while len(texts) < size:
        kind = rng.randint(0, 5)
        text = prose(rng.choice([5, 40, 120, 400]))
        if kind == 0 and len(texts) > 8:
            text = rng.choice(texts[6:])
        elif kind == 1 and len(texts) > 8:
            parts = rng.choice(texts[6:]).split(" ")
            parts[rng.randrange(len(parts))] = "changed"
            text = " ".join(parts)
        elif kind == 2:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + " " + rng.choice(passages) + " " + text[at:]
        elif kind == 3:
            text = text + "\n" + line.upper() + " \n" + prose(3)
        texts.append(text)
    texts.append(prose(4000) + passages[0])
    rng.shuffle(texts)
    return list(enumerate(texts, 10))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOC_SCHEMA)


def tables(tmp_path, **frames):
    """Write tables as the driver lays them out; returns the folder."""
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
