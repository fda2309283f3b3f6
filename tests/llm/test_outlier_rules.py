"""Single statistics that make an outlier, and small groups of a large table."""

import random

from lexiloom.llm import outliers

DOC = "doc_id long, text string, lang string, source string"


def regular(maker, n_lines=60):
    return "\n".join(" ".join(f"w{maker.randrange(10**6):06d}" for _ in range(6)) for _ in range(n_lines))


def run(spark, rows):
    return {r.doc_id: r for r in outliers.robust_outliers(spark.createDataFrame(rows, DOC).repartition(4)).collect()}


def test_repeated_lines_alone_make_an_outlier(spark):
    maker = random.Random(4)
    rows = [(i, regular(maker), "en", "a") for i in range(300)]
    lines = regular(maker, 20).split("\n")
    rows.append((300, "\n".join(f"{line}\nagain00\nagain00\nagain00" for line in lines), "en", "a"))
    found = run(spark, rows)
    assert not found[300].base_failed and found[300].n_repeat_words == 0
    assert not found[300].kept
    assert sum(r.kept for r in found.values()) >= 290


def test_lines_and_words_repeated_in_part_make_an_outlier(spark):
    """Half of the lines are there before, a quarter of the words in repeated passages."""
    maker = random.Random(5)
    rows = [(i, regular(maker), "en", "a") for i in range(300)]
    lines = regular(maker, 26).split("\n")
    passage = "\n".join(lines[:4])
    mixed = [passage, passage] + [f"{line}\nagain00" for line in lines[4:]]
    rows.append((300, "\n".join(mixed), "en", "a"))
    found = run(spark, rows)
    assert not found[300].base_failed and found[300].n_repeat_words == 48
    assert not found[300].kept


def test_small_groups_are_held_against_the_whole_table(spark):
    maker = random.Random(6)
    rows = [(i, regular(maker), "en", "a") for i in range(300)]
    rows += [(300 + i, regular(maker), "de", f"s{i}") for i in range(5)]
    rows.append((305, " ".join(["#$%&|<>*" * 5] * 7 + regular(maker, 3).split()), "fr", "b"))
    found = run(spark, rows)
    assert all(r.distance is not None for r in found.values())
    assert all(found[300 + i].kept for i in range(5))
    assert not found[305].base_failed and not found[305].kept
