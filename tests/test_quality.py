import pytest

from paylake.operators import quality
from paylake.operators.keys import distinct_keys, union_keys


def frame(spark):
    return spark.createDataFrame(
        [("a", 1, 5), ("a", 1, -1), (None, 2, 0), (None, 2, None)],
        "id string, part int, amount bigint",
    )


def test_required_columns(spark):
    counts = quality.check_required_columns(frame(spark), ["id", "part", "absent"])
    assert counts == {"id": 2, "part": 0, "absent": -1}
    assert quality.check_required_columns(frame(spark), []) == {}
    quality.refuse_bad_columns("x", {"absent": -1})
    with pytest.raises(quality.QualityError):
        quality.refuse_bad_columns("x", {"absent": -1}, strict=True)
    with pytest.raises(quality.QualityError):
        quality.refuse_bad_columns("x", {"id": 2})


def test_negative_values(spark):
    assert quality.check_negative_values(frame(spark), ["amount", "absent"]) == {"amount": 1}
    with pytest.raises(quality.QualityError):
        quality.refuse_negative("x", {"amount": 1})


def test_duplicates_count_null_keys(spark):
    assert quality.count_duplicates(frame(spark), ["id", "part"]) == 2
    assert quality.count_duplicates(frame(spark).limit(0), ["id"]) == 0
    with pytest.raises(quality.QualityError):
        quality.refuse_duplicates("x", 1)


def test_key_sets(spark):
    df = frame(spark)
    assert [r[0] for r in distinct_keys(df, "id").collect()] == ["a"]
    other = spark.createDataFrame([("b",), (None,), ("a",)], "id string")
    assert sorted(r[0] for r in union_keys([df, other], "id").collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        union_keys([], "id")


def test_id_hygiene(spark):
    df = spark.createDataFrame([("pay-batch-1",), ("pay1",), (None,)], "payment_id string")
    assert quality.id_hygiene(df, "payment_id").first()["bad_ids"] == 1
    assert tuple(quality.grain(df, "payment_id").first()) == (3, 2)
