import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from graphloom.functions import ids, text


def one(spark, column, **values):
    ddl = ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], ddl).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("name", ["", "a", "Ärger 😀", "x" * 500])
def test_uuid5_equals_the_standard_library(spark, name):
    space = uuid.uuid5(uuid.NAMESPACE_DNS, "other")
    assert one(spark, ids.uuid5(str(space), F.col("n")), n=name) == str(uuid.uuid5(space, name))
    assert one(spark, ids.uuid5("no uuid", F.col("n")), n=name) == str(uuid.uuid5(uuid.uuid5(uuid.NAMESPACE_DNS, "no uuid"), name))
    assert one(spark, ids.uuid5(F.col("s"), F.col("n")), s=str(space), n=name) == str(uuid.uuid5(space, name))


def test_chunk_ids_refuse_what_is_no_span(spark):
    doc = str(uuid.uuid4())
    assert one(spark, ids.chunk_id(F.col("d"), F.col("a"), F.col("b")), d=doc, a=0, b=5) == str(uuid.uuid5(uuid.UUID(doc), "0:5"))
    for a, b in ((5, 5), (-1, 3), (7, 2)):
        with pytest.raises(PySparkException, match="not a span"):
            one(spark, ids.chunk_id(F.col("d"), F.col("a"), F.col("b")), d=doc, a=a, b=b)


@pytest.mark.parametrize(
    ("name", "prefix", "base", "key"),
    [
        ("DOC_0007_A  B - X.v2.pdf", "DOC_0007", "DOC_0007_A  B - X.v2", "a b x v2"),
        ("doc_12345.md", "DOC_1234", "doc_12345", "5"),
        ("dir/DOC_0001_x DOC_0002.txt", "DOC_0001", "DOC_0001_x DOC_0002", "x"),
        ("a\\b.pdf", "", "a\\b", "a\\b"),
        ("no extension", "", "no extension", "no extension"),
        ("", "", "", ""),
    ],
)
def test_name_keys(spark, name, prefix, base, key):
    assert one(spark, text.doc_prefix(F.col("n")), n=name) == prefix
    assert one(spark, text.base_name(F.col("n")), n=name) == base
    assert one(spark, text.title_key(F.col("n")), n=name) == key


def test_text_helpers(spark):
    assert one(spark, text.entity_text(F.col("t")), t="  Ácme,\t Corp. – É-a_ß! ") == "ácme corp é-a_ß"
    assert one(spark, text.strip(F.col("t")), t="  a b \r\n") == "a b"
    assert one(spark, text.clipped(F.col("t")), t="x" * 600) == "x" * 497 + "..."
    assert one(spark, text.clipped(F.col("t")), t=" y ") == "y"
    assert one(spark, text.json_text(F.col("t")), t='a"b\\c\né') == '"a\\"b\\\\c\\né"'
    assert one(spark, text.page_label(F.col("n"), F.col("p")), n="DOC_12_x.pdf", p=3) == "DOC_12-003"
    assert one(spark, text.page_label(F.col("n"), F.col("p")), n="a_b_c", p=1) == "A_B-001"
    assert one(spark, text.safe_name(F.col("p"), F.col("n")), n="a/b:c é.pdf", p=7) == "DOC_0007_abc é.pdf"


def test_bytes(spark):
    row = spark.createDataFrame([(b"ab\xffc\xc3\xa9",)], "b binary").select(text.utf8(F.col("b")).alias("u")).first()
    assert row["u"] == "abcé"
    accents = b"\x00caf\xe9 d\xe9\x00abc\xadd\x00"  # the soft hyphen is not printable
    assert spark.createDataFrame([(accents,)], "b binary").select(text.printable_runs(F.col("b")).alias("u")).first()["u"] == "caf\xe9 d\xe9"
    moment = F.lit("2024-01-31 23:59:59.5").cast("timestamp")
    assert spark.range(1).select(text.utc_text(moment), text.stamp(moment)).first() == ("2024-01-31T23:59:59.500000Z", "20240131_235959")
    doc = b"\x00\x01Hello\x00ab\x00World!\x02tail"
    assert spark.createDataFrame([(doc,)], "b binary").select(text.printable_runs(F.col("b")).alias("u")).first()["u"] == "Hello\nWorld!"
