import pytest
from conftest import as_dicts

from orcaspark.lookups import PLANNED_CAPTIONS
from orcaspark.operators import keys

PREPARED = "PROJETO string, ACAO string, UNIDADE string, ANO int, CHAVE_CONCAT string, v int"


def test_prepare_cleans_keys_and_years(rows):
    df = rows(
        [(" P ", "A", None, "2025.0"), ("P", "\tA", "U", "x"), ("P", "A", "U", None)],
        "PROJETO string, ACAO string, UNIDADE string, ANO string",
    )
    found = [r["CHAVE_CONCAT"] for r in as_dicts(keys.prepare_keys(df))]
    assert found == ["P|A|N/A|2025", "P|A|U|0", "P|A|U|0"]


def test_prepare_renames_source_captions(rows):
    captions = list(PLANNED_CAPTIONS)
    df = rows([("P", "A", "SP - U", "2025", 1, "PPA", "1", "n", 5.0)], "a string, b string, c string,"
              " d string, e int, f string, g string, h string, i double").toDF(*captions)
    row = as_dicts(keys.prepare_keys(df))[0]
    assert row["UNIDADE"] == "U" and row["ANO_FOTOGRAFIA"] == "2025"
    assert row["CHAVE_CONCAT"] == "P|A|U|2025"
    assert set(PLANNED_CAPTIONS.values()) <= set(row)


def test_prepare_derives_the_year_of_cost_centers(rows):
    schema = "CODCCUSTO string, PROJETO string, ACAO string, UNIDADE string, DTACAO string"
    df = rows([("1", "P", "A", "U", "2024-05-01 10:00:00"), ("2", "P", "A", "U", "?")], schema)
    assert [r["ANO"] for r in as_dicts(keys.prepare_keys(df))] == [2024, 0]


def test_missing_columns_are_named(rows):
    with pytest.raises(KeyError, match="UNIDADE"):
        keys.prepare_keys(rows([("P", "A", 1)], "PROJETO string, ACAO string, ANO int"))


def corrections(rows, *pairs):
    return rows(list(pairs), "ChaveQuebrada string, ChaveCorreta string")


def test_corrections_replace_parts_and_keep_the_first_key(rows):
    df = rows(
        [(p, "A", "U", 2025, f"{p}|A|U|2025", i) for i, p in enumerate("abcdefg")], PREPARED
    )
    fixes = corrections(
        rows,
        ("a|A|U|2025", "P|B|V|2024"),
        ("b|A|U|2025", "P|B|V"),  # three parts
        ("c|A|U|2025", "P|B|V|2024.0"),  # no integer year
        ("d|A|U|2025", "P|B|V| 2024 |x"),  # a fifth part is ignored
        ("e|A|U|2025", ""),
        ("unknown", "P|B|V|2024"),
        (None, "P|B|V|2024"),
    )
    found = {r["v"]: r for r in as_dicts(keys.apply_corrections(df, fixes))}
    assert len(found) == 7
    assert found[0]["CHAVE_CONCAT"] == "P|B|V|2024" == found[3]["CHAVE_CONCAT"]
    assert found[0]["CHAVE_CONCAT_original"] == "a|A|U|2025"
    for i in (1, 2, 4, 5, 6):
        assert found[i]["CHAVE_CONCAT"] == found[i]["CHAVE_CONCAT_original"]


def test_last_correction_wins_and_rows_never_multiply(rows):
    df = rows([("a", "A", "U", 1, "a|A|U|1", 0)] * 3, PREPARED)
    fixes = rows(
        [("a|A|U|1", "x|A|U|1", 2), ("a|A|U|1", "z|A|U|1", 1)],
        "ChaveQuebrada string, ChaveCorreta string, linha int",
    )
    by_order = as_dicts(keys.apply_corrections(df, fixes, "linha"))
    assert [r["PROJETO"] for r in by_order] == ["x"] * 3
    assert [r["PROJETO"] for r in as_dicts(keys.apply_corrections(df, fixes))] == ["x"] * 3
    unordered = keys.apply_corrections(df, fixes.drop("linha"))
    assert [r["PROJETO"] for r in as_dicts(unordered)] == ["z"] * 3


def test_empty_corrections_only_keep_the_original_key(rows):
    df = rows([("a", "A", "U", 1, "a|A|U|1", 0)], PREPARED)
    row = as_dicts(keys.apply_corrections(df, corrections(rows)))[0]
    assert row["CHAVE_CONCAT_original"] == row["CHAVE_CONCAT"] == "a|A|U|1"


def test_unmatched_keys_and_rebuild(rows):
    df = rows(
        [("a", "A", "U", 1, "a|A|U|1", 0), ("b", "A", "U", 1, "b|A|U|1", 0)] * 2, PREPARED
    )
    reference = df.filter("PROJETO = 'b'")
    assert [r[0] for r in keys.unmatched_keys(df, reference).collect()] == ["a|A|U|1"]
    fixed = keys.apply_corrections(df, corrections(rows, ("a|A|U|1", "b|A|U|1")))
    assert keys.rebuild_corrections(fixed).collect() == [("a|A|U|1", "b|A|U|1")]
