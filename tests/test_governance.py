from changeflow.functions.masks import apply_masks, mask_cpf, mask_email, mask_phone, register_sql_functions, row_filter


def test_masks_edge_cases(spark):
    df = spark.createDataFrame(
        [("a@x.com", "", "123"), ("no-at", "1", "1234"), ("a@b@c", "12", "11987654321"), (None, "12345678901", None)],
        "email string, cpf string, telefone string",
    )
    out = df.select(mask_email("email").alias("e"), mask_cpf("cpf").alias("c"), mask_phone("telefone").alias("t")).collect()
    assert [tuple(r) for r in out] == [
        ("***@x.com", "***.***.*-**", "****"),
        ("***@desconhecido", "***.***.*-**", "****1234"),
        ("***@b", "***.***.*12", "****4321"),
        ("***@desconhecido", "***.***.*01", "****"),
    ]


def test_pii_readers_see_values(spark):
    df = spark.createDataFrame([("a@x.com", "12345678901", "11987654321")], "email string, cpf string, telefone string")
    assert tuple(apply_masks(df, {"pii_readers"}).first()) == ("a@x.com", "12345678901", "11987654321")
    assert tuple(apply_masks(df, {"analysts"}).first()) == ("***@x.com", "***.***.*01", "****4321")


def test_row_filter_unlisted_region_is_hidden(spark):
    policy = spark.createDataFrame([("analysts", "SP"), ("other", "BA")], "grupo string, uf string")
    df = spark.createDataFrame([(1, "SP"), (2, "BA"), (3, "PE"), (4, None)], "id int, uf string")
    assert [r.id for r in row_filter(df, policy, {"analysts"}).collect()] == [1]
    assert row_filter(df, policy, {"nobody"}).count() == 0
    assert row_filter(df, policy, {"admins"}).count() == 4


def test_sql_mask_functions(spark):
    register_sql_functions(spark, ())
    r = spark.sql("SELECT mask_email('a@b@c') AS e, mask_cpf('1') AS c, mask_phone('11987654321') AS t").first()
    assert tuple(r) == ("***@b", "***.***.*-**", "****4321")
