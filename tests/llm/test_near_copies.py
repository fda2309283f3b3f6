"""One row of each component of near copies, whatever the ids."""

from lexiloom.llm import near_dedup

DOC = "doc_id long, text string"


def words(name, changed=0):
    """200 shingles of five words, of which 5 for each changed word are others."""
    listed = [f"{name}{i}" for i in range(204)]
    for i in range(changed):
        listed[10 + 10 * i] = f"other{i}"
    return " ".join(listed)


def test_one_of_each_with_repeated_and_null_ids(spark):
    rows = [
        (1, words("a")), (2, words("a", 1)), (1, words("b")), (3, words("b", 1)),
        (None, words("c")), (None, words("c", 1)), (None, words("d")), (4, words("d", 1)), (None, words("e")),
    ]
    kept = [(r.doc_id, r.text) for r in near_dedup.one_of_each(spark.createDataFrame(rows, DOC)).collect()]
    null_c = [k for k in kept if k in rows[4:6]]
    assert len(null_c) == 1
    assert sorted(map(str, set(kept) - set(null_c))) == sorted(map(str, [rows[0], rows[2], rows[7], rows[8]]))
    assert len(kept) == 5
