import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cotejo.operators.packed import split_array, split_packed, split_value


@pytest.mark.parametrize(
    ("text", "values"),
    [
        (None, []),
        ("", []),
        ("  ", []),
        ("uno", ["uno"]),
        ("uno, dos;tres|cuatro", ["uno", "dos", "tres", "cuatro"]),
        ("uno,, ;dos", ["uno", "dos"]),
        ("uno\ndos\r\ntres\tcuatro", ["uno", "dos", "tres", "cuatro"]),
        ("co-demandado", ["co-demandado"]),
        ("uno - dos – tres / cuatro", ["uno", "dos", "tres", "cuatro"]),
        ("daños y/o perjuicios", ["daños y/o perjuicios"]),
        ("Ley N.° 1: artículo 2 y 3", ["Ley N.° 1: artículo 2 y 3"]),
        ('"a; b", c', ["a; b", "c"]),
        ("«a, b»; 'c | d'", ["a, b", "c | d"]),
        ('"cláusula ""x, y"""; z', ['cláusula "x, y"', "z"]),
        ("'cláusula \"a, b\"', c", ['cláusula "a, b"', "c"]),
        ('5" tubo, otro', ['5" tubo', "otro"]),
        ('"abierto, dos', ['"abierto', "dos"]),
        ("d'or, N'guema", ["d'or", "N'guema"]),
        ("a, a, b", ["a", "a", "b"]),
        ('"", a, ""', ["a"]),
        ("\xa0a\xa0,\xa0b", ["a", "b"]),
        (", ".join(["x"] * 20_000), ["x"] * 20_000),
    ],
)
def test_values(text, values):
    assert split_value(text) == values
    off, flat = split_array(pa.array(["before", text, "after"], pa.string()))
    assert flat.to_pylist()[off[1] : off[2]] == values


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=list("ab \"'«»“”,;|\n\t\r-–—/•·\xa0 é"), max_size=16)), max_size=12))
def test_arrays_and_characters_agree(texts):
    off, flat = split_array(pa.array(texts, pa.string()))
    assert [flat.to_pylist()[off[k] : off[k + 1]] for k in range(len(texts))] == [split_value(t) for t in texts]


def test_rows(spark, rows):
    df = spark.createDataFrame([(1, "a;b", None, "x"), (2, "solo", "p , q", "y"), (2, "solo", "p , q", "y"), (3, None, "", "z")], "id long, palabras string, norma string, field_value string")
    got = rows(split_packed(df, "id", ["palabras", "norma"], at_least=2))
    assert got == sorted([(1, "palabras", 1, "a"), (1, "palabras", 2, "b")] + 2 * [(2, "norma", 1, "p"), (2, "norma", 2, "q")], key=repr)
    assert rows(split_packed(df.filter("id > 9"), "id", ["palabras"])) == []
