import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktally.sources import readers, sinks


def put(path, text: str, newline="\n"):
    path.write_bytes(text.replace("\n", newline).encode())
    return str(path)


def test_ratings_tolerate_bad_lines(spark, tmp_path):
    a = put(tmp_path / "r1.txt", "7, 1020, 4.5, 1577836800\n\n8, 1020, x, 1577836800\n9, 1020\n1,2,3", "\r\n")
    b = put(tmp_path / "r2.txt", "7,1021, 5 ,1577836801,surplus\n7,1021,2,\n")
    four = readers.read_ratings(spark, [a, b], min_fields=4)
    assert rows(four) == [("7", "1020", 4.5, 1577836800), ("7", "1021", 2.0, None), ("7", "1021", 5.0, 1577836801)]
    three = readers.read_ratings(spark, [a, b])
    assert rows(three) == [("1", "2", 3.0, None), ("7", "1020", 4.5, 1577836800),
                           ("7", "1021", 2.0, None), ("7", "1021", 5.0, 1577836801)]
    assert readers.read_ratings(spark, [a, b], on_bad="null").where("rating is null").count() == 1
    with pytest.raises(Exception, match="not a number: x"):
        readers.read_ratings(spark, [a, b], on_bad="fail").collect()
    with pytest.raises(ValueError):
        readers.read_ratings(spark, a, on_bad="other")
    assert rows(readers.rating_rejects(spark, [a, b], 4)) == [(6, 2, 1)]


def test_an_empty_rating_is_bad_and_not_short(spark, tmp_path):
    path = put(tmp_path / "r.txt", "1,10,4,100\n2,10,,100\n3,10\n")
    assert rows(readers.read_ratings(spark, path)) == [("1", "10", 4.0, 100)]
    assert rows(readers.read_ratings(spark, path, on_bad="null")) == [("1", "10", 4.0, 100), ("2", "10", None, 100)]
    with pytest.raises(Exception, match="not a number"):
        readers.read_ratings(spark, path, on_bad="fail").collect()
    assert rows(readers.rating_rejects(spark, path)) == [(3, 1, 1)]


def test_users_occupations_movies(spark, tmp_path):
    users = put(tmp_path / "u.txt", "1, M, 28, 3, 12345\n2,f,abc,4,1\n3\n", "\r\n")
    assert rows(readers.read_users(spark, users)) == [("1", "M", 28, "3", "12345"), ("2", "f", None, "4", "1")]
    occ = put(tmp_path / "o.txt", "1,Programmer\n2\n")
    assert rows(readers.read_occupations(spark, occ)) == [("1", "Programmer")]
    quoted = put(tmp_path / "m.txt", '1,"Good, the ""Bad""",Western|Drama\n2,Plain,Action\n')
    assert rows(readers.read_movies(spark, quoted, "csv")) == [
        ("1", 'Good, the "Bad"', "Western|Drama"), ("2", "Plain", "Action")]
    plain = put(tmp_path / "m2.txt", "1, Good, the Bad, Western\nshort\n", "\r\n")
    assert rows(readers.read_movies(spark, plain)) == [("1", "Good, the Bad", "Western")]


def test_delimited_reviews(spark, tmp_path):
    path = put(tmp_path / "h.csv", 'id;review;category;aspect;sentiment\n1;a "b" c;X;Y;positive;surplus\n2;short\n3;;X;Y;\n')
    assert rows(readers.read_reviews(spark, path)) == [
        (1, 'a "b" c', "X", "Y", "positive"), (2, "short", None, None, None), (3, None, "X", "Y", None),
        (None, "review", "category", "aspect", "sentiment")]


def test_wordlist(spark, tmp_path):
    path = put(tmp_path / "w.txt", "tôi\ntại sao\n\n tôi\n", "\r\n")
    assert rows(readers.read_wordlist(spark, path)) == [("tôi",), ("tại sao",)]


def test_commerce_tables_with_inferred_types(spark, tmp_path):
    put(tmp_path / "Orders.csv", "Order_ID;Customer_Trx_ID;Order_Purchase_Timestamp;Extra\no1;c1;2024-01-31 10:00:00;1\n")
    put(tmp_path / "Customer_List.csv", "Customer_Trx_ID;Customer_Country\nc1;Germany\n")
    put(tmp_path / "Order_Items.csv", "Order_ID;Product_ID;Seller_ID;Price;Freight_Value;Shipping_Limit_Date\no1;p1;s1;10.5;1.5;2024-02-02 00:00:00\n")
    put(tmp_path / "Order_Reviews.csv", "Order_ID;Review_Score\no1;5\no1;abc\n")
    put(tmp_path / "Products.csv", "Product_ID;Product_Category_Name\np1;Toys\n")
    tables = readers.read_commerce(spark, str(tmp_path))
    assert dict(tables["orders"].dtypes) == {"order_id": "string", "customer_id": "string", "purchase_ts": "timestamp"}
    assert dict(tables["items"].dtypes)["price"] == "double"
    assert rows(tables["reviews"]) == [("o1", "5"), ("o1", "abc")]
    two = {"products": tables["products"], "reviews": tables["reviews"]}
    report = readers.describe_schema(two, counts=True)
    assert rows(readers.describe_schema(two)) == [r[:4] for r in rows(report)]
    assert rows(report) == [("products", 1, "product_id", "string", 1), ("products", 2, "category", "string", 1),
                            ("reviews", 1, "order_id", "string", 2), ("reviews", 2, "score", "string", 2)]
    declared = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    assert readers.read_table(spark, str(tmp_path / "Products.csv"), schema=declared).columns == ["a", "b"]


def test_lines_modes_and_single_file(spark, tmp_path):
    df = spark.range(40).repartition(4)
    lines = sinks.render_lines(df, F.concat(F.lit("n="), F.col("id").cast("string")))
    path = str(tmp_path / "out")
    sinks.write_lines(lines, path, single_file=True)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    with pytest.raises(AnalysisException):
        sinks.write_lines(lines, path)
    sinks.write_lines(lines, path, mode="overwrite")
    assert len(list((tmp_path / "out").glob("part-*"))) > 1
    assert spark.read.text(path).count() == 40


def test_table_sink_keeps_quotes_and_flattens(spark, tmp_path):
    df = spark.sql("""select 1 as id, ' a "b"' as t, array(struct('w' as word, 2 as freq)) as top, cast(null as string) as n""")
    sinks.write_table(df, str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).first()[0] == '1\t a "b"\t[{"word":"w","freq":2}]\t'
    sinks.write_table(df.select("id", "t"), str(tmp_path / "h"), sep=";", header=True)
    back = readers.read_table(spark, str(tmp_path / "h"))
    assert back.columns == ["id", "t"] and back.count() == 1


def test_split_and_shared_outputs(spark, tmp_path):
    df = spark.createDataFrame([("a", "positive"), ("b", "negative"), ("c", "positive")], "w string, sentiment string")
    sinks.write_split(df, "sentiment", str(tmp_path / "s"))
    assert rows(spark.read.parquet(str(tmp_path / "s" / "sentiment=positive"))) == [("a",), ("c",)]
    sinks.write_outputs(df, [
        lambda d: sinks.write_table(d.where("sentiment = 'positive'"), str(tmp_path / "p")),
        lambda d: sinks.write_table(d.where("sentiment = 'negative'"), str(tmp_path / "n"))])
    assert spark.read.text(str(tmp_path / "p")).count() == 2
    assert spark.read.text(str(tmp_path / "n")).count() == 1


def test_frames_folder(spark, tmp_path):
    for name in ("b.jpg", "a.png", "c.jpeg", "d.txt"):
        put(tmp_path / name, name)
    frames = readers.read_frames(spark, str(tmp_path))
    listed = [r.path.rsplit("/", 1)[1] for r in readers.frame_paths(frames).collect()]
    assert listed == ["a.png", "b.jpg", "c.jpeg"]
