from collections import Counter

import pytest

from lexiloom.operators import dictionary
from lexiloom.plans import jobs
from lexiloom.schemas import DICTIONARY
from lexiloom.sources import readers, writers


def sense(glosses=None, tags=None, forms=None):
    return {"glosses": glosses, "tags": tags, "form_of": forms and [{"word": w} for w in forms]}


def entry(word, senses, lang="es", pos="noun"):
    return {"word": word, "lang_code": lang, "pos": pos, "senses": senses}


@pytest.fixture
def entries(spark):
    return spark.createDataFrame(
        [
            entry("casa", [sense(["house", "home"]), sense(["house"], ["rare"])]),
            entry("casa", [sense(["house"])]),
            entry("viejo", [sense(["old"], ["archaic"], ["vetus"]), sense(["aged"], [])], pos="adj"),
            entry("corro", [sense(["of correr"], ["form-of"], ["correr", "correr"])], pos="verb"),
            entry("corro", [sense(None, None, ["correr", None])], pos="verb"),
            entry("hoy", [sense(["today"])], pos="adv"),
            entry("chat", [sense(["cat"])], lang="fr"),
            entry(None, [sense(["nothing"])]),
            entry("vacío", []),
            entry("nulo", None),
            entry("dep", [sense(["x"], ["obsolete", "rare"]), sense(["y", "y"], None)]),
        ],
        DICTIONARY,
    )


def test_definitions_are_distinct_per_entry_only(entries):
    rows = dictionary.definitions(dictionary.select_entries(entries)).collect()
    assert Counter((r.word, r.definition) for r in rows) == Counter(
        [
            ("casa", "house"),
            ("casa", "home"),
            ("casa", "house"),
            ("viejo", "aged"),
            ("dep", "y"),
        ]
    )


def test_forms_come_from_excluded_senses_too_and_are_distinct(entries):
    rows = dictionary.forms(dictionary.select_entries(entries)).collect()
    assert sorted(tuple(r) for r in rows) == [("corro", "correr"), ("viejo", "vetus")]


def test_kept_senses_keep_their_place(entries):
    rows = dictionary.sense_rows(dictionary.select_entries(entries)).filter("word = 'dep'").collect()
    assert [(r.sense, r.glosses) for r in rows] == [(1, ["y", "y"])]


def test_bad_bytes_go_and_bad_lines_are_quarantined(spark, tmp_path):
    path = tmp_path / "words.jsonl"
    path.write_bytes(
        b'{"word":"ca\xffsa","lang_code":"es","pos":"noun","senses":[{"glosses":["home\xfe"]}],"extra":1}\n'
        b"{bad\n"
        b'{"lang_code":"es","pos":"noun","senses":[]}\n'
    )
    good, bad = readers.split_corrupt(readers.scan_dictionary(spark, str(path), DICTIONARY))
    assert [r.corrupt for r in bad.collect()] == ["{bad"]
    assert good.count() == 2
    rows = dictionary.definitions(dictionary.select_entries(good)).collect()
    assert [tuple(r) for r in rows] == [("casa", "home")]


def test_job_writes_both_tables(spark, entries, folder):
    jobs.dictionary_tables(entries, f"{folder}/out")
    read = spark.read.options(**writers.CSV_READ_OPTIONS)
    assert read.csv(f"{folder}/out/words").columns == ["word", "definition"]
    assert read.csv(f"{folder}/out/forms").columns == ["word", "original form"]
    assert read.csv(f"{folder}/out/words").count() == 5
