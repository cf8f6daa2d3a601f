"""Small inputs that the operators' tests share."""

from __future__ import annotations

import random

from scoreloom.shared_store import Workspace

EXTRA = "doc_id BIGINT, text STRING, t1 STRING, content STRING, score STRING, node INT, spans INT, shard STRING, _kept INT, item INT"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def corpus(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Null, empty and long texts, exact and near copies, shared passages, repeated rows."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(20, 120)) for _ in range(14)]
    passage = " ".join(words(rng, 70))
    texts: list[str | None] = [None, "", " \n\t ", "one", "one two three", "Ünïcode ß — 日本語 text " * 3]
    for b in base:
        texts.append(" ".join(b))
        near = list(b)
        near[rng.randrange(len(b))] = "changed"
        texts.append(" ".join(near))
    texts += [" ".join(base[0]), " ".join(base[0]).upper(), " ".join(base[1]) + " " + passage, passage + "\n" + " ".join(base[2])]
    texts += ["aaaa " * 300, "\n".join(" ".join(words(rng, 9)) for _ in range(5))]
    line = words(rng, 10)
    texts += ["\n".join([" ".join(line), " ".join(line[:-1]), " ".join([*line[:4], "other", *line[5:]]), "short one", "short two"])]
    texts += ["short one\n\nshort  one\n" + " ".join(line).title()]
    texts.append(" ".join(words(rng, 6000)))
    rows = [(10 + 3 * i, t) for i, t in enumerate(texts)]
    return [*rows, rows[8], rows[8], (None, texts[9]), (2**62 + 1, "last of all")]


def documents(spark, rows, extra: bool = True):
    """A table of documents, with further columns whose names operators might use themselves."""
    if not extra:
        return spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    return spark.createDataFrame([(i, t, "x", "y", "z", 1, 2, None, 3, 4) for i, t in rows], EXTRA)


def workspace(spark) -> Workspace:
    return Workspace(spark, "test")
