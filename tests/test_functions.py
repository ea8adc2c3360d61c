"""Text, id and vector functions against known answers."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.functions import ids, text, vectors, vocab


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(("token", "h"), [("pythagore", 97600914), ("œuvre", 397233820), ("thalès", 1781661221), ("5e", 1491139823), ("où", 1479759909), ("", 18652613)])
def test_fnv1a(spark, token, h):
    assert one(spark, token, text.fnv1a) == h


def test_tokens(spark):
    assert one(spark, "L'Œuvre ÇA 5e Noël où THÉORÈME", text.tokens) == ["l", "œuvre", "ça", "5e", "noël", "où", "théorème"]
    assert one(spark, "", text.tokens) == []


def test_uuid5_equals_python(spark):
    for name in ("", "a", "mathematiques:cinquieme:é"):
        assert one(spark, name, ids.uuid5) == str(uuid.uuid5(uuid.NAMESPACE_URL, name))


def test_point_id(spark):
    row = spark.createDataFrame([("mathematiques", "cinquieme", "Un nombre relatif é")], "m string, n string, t string")
    assert row.select(ids.point_id(F.col("m"), F.col("n"), F.col("t"))).first()[0] == "5f635605-0831-5da9-91b6-afb675fcfa17"


@pytest.mark.parametrize(("raw", "out"), [("## **Nombres**", "Nombres"), ("### __*Deep*__", "Deep"), (" • item", "item"), ("plain", "plain"), ("**a** and _b_", "a and b")])
def test_unwrapped(spark, raw, out):
    assert one(spark, raw, text.unwrapped) == out


@pytest.mark.parametrize(("line", "ok"), [("Titre", True), ("", False), ("- item", False), ("| a | b |", False), ("a|b|c|d", False), ("Une phrase.", False), ("## Titre :", True), ("→ suite", False)])
def test_title_like(spark, line, ok):
    assert one(spark, line, text.title_like) is ok


def test_title_key(spark):
    assert one(spark, "  L'Élève à l'ŒUVRE !  ", text.title_key) == "leleve a luvre"


def test_match_key(spark):
    assert one(spark, "L’ﬁn Straße", text.match_key) == "l'fin strasse"


def test_stripped_takes_any_space(spark):
    assert one(spark, " \t a b  \n", text.stripped) == "a b"


def test_levels_and_cycles(spark):
    rows = {"programme_x_cycle4_BO": 3, "PROGRAMME_X_CYCLE3_BO": 1, "p_college_BO": 4, "p_lycee_BO": 3}
    for name, n in rows.items():
        assert len(one(spark, name, vocab.levels_of_file)) == n
    assert one(spark, "sixieme", vocab.cycle_of) == "cycle3"
    with pytest.raises(Exception, match="unknown level"):
        one(spark, "maternelle", lambda c: vocab.cycle_of(c, strict=True))


def test_unit_and_cosine(spark):
    rows = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<double>, b array<double>")
    u, c = rows.select(vectors.unit(F.col("a")), vectors.cosine(F.col("a"), F.col("b"))).first()
    assert u == [0.6, 0.8] and math.isclose(c, 0.96)
    with pytest.raises(Exception, match="zero vector"):
        spark.createDataFrame([([0.0],)], "a array<double>").select(vectors.unit(F.col("a"))).collect()


def test_quantized(spark):
    rows = spark.createDataFrame([([1.0, -2.0, 0.5],)], "a array<double>")
    assert rows.select(vectors.quantized(F.col("a"), F.lit(1.0))).first()[0] == [127, -127, 64]


def test_shortened(spark):
    assert one(spark, "x" * 251, text.shortened) == "x" * 250 + "…"
    assert one(spark, "x" * 250, text.shortened) == "x" * 250
