import random

import pytest

#: Columns that operators might use themselves.
CLASHING = ["fp", "id", "key", "hash", "__text", "__fp", "start", "seg", "label", "n", "hits", "c0", "class"]


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    source = random.Random(seed)
    parts = []
    for _ in range(words):
        parts.append("".join(source.choice("aeioubcdlmnprst") for _ in range(2 + source.randrange(vocabulary) % 6)))
        parts.append(source.choice([" ", " ", " ", " ", ", ", ". ", ".\n", "\n"]))
    return "".join(parts)


def tricky_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and long texts, exact copies, near copies, shared passages, repeated rows, odd characters."""
    base = [prose(i, 60 + 13 * i) for i in range(6)]
    shared = prose(99, 70)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(10, base[0]), (11, base[1]), (12, base[1])]
    words = base[5].split(" ")
    for i in range(4):
        changed = list(words)
        changed[20 + 5 * i] = "другой"
        rows.append((20 + i, " ".join(changed)))
    rows += [(30 + i, prose(200 + i, 50) + " " + shared + " " + prose(300 + i, 40)) for i in range(6)]
    rows += [(40, shared + "\n" + shared), (41, "ab " * 400), (42, "a" * 900), (43, prose(7, 3000))]
    rows += [(50, None), (51, ""), (52, " \n\t "), (53, "word"), (54, "日本語 ß é   x\x0by")]
    rows += [(None, base[2]), (None, None), (60, prose(8, 80)), (60, prose(8, 80)), (60, prose(9, 80))]
    return rows


@pytest.fixture(scope="session")
def texts():
    return tricky_texts()


@pytest.fixture
def docs_of(spark):
    """Documents with columns whose names operators might use for themselves."""

    def make(rows):
        extra = ", ".join(f"{name} string" for name in CLASHING)
        return spark.createDataFrame([(*row, *CLASHING) for row in rows], f"doc_id bigint, text string, {extra}").repartition(3)

    return make


@pytest.fixture
def untouched():
    """Whether the clashing columns came through."""

    def check(df):
        assert set(CLASHING) <= set(df.columns)
        for row in df.select(CLASHING).distinct().collect():
            assert list(row) == CLASHING

    return check
