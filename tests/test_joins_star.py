import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from support import plan, rows
from lakestar.operators import (
    assert_unique_key,
    Computed,
    Lookup,
    build_fact,
    dimension,
    dimension_from_fact,
    join_members,
    link_dimension,
    lookup_join,
    profile_lookup,
    resolve_fk,
)
from lakestar.operators.bloom import bloom_words
from lakestar.operators.joins import hot_keys, pruned, salted_join
from lakestar.plans import gold


def _skewed(spark, n=3000):
    rng = random.Random(2)
    keys = [("hot", 1)] * (n // 3) + [(None, 1)] * (n // 4) + [("hot", None)] * 50
    keys += [(f"k{rng.randrange(40)}", rng.randrange(3)) for _ in range(n - len(keys))]
    rng.shuffle(keys)
    return [(i, *k) for i, k in enumerate(keys)]


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [10**9, -1])
def test_lookup_join_against_brute_force(spark, null_safe, how, limit):
    left = _skewed(spark)
    right = [("hot", 1, 10), (None, 1, 20), ("hot", None, 30)] + [(f"k{i}", 0, 100 + i) for i in range(30)]
    right += [(f"k{i}", 2, 200 + i) for i in range(0, 40, 2)]
    expected = []
    for row in left:
        found = [r for r in right if (r[0], r[1]) == row[1:] and (null_safe or None not in r[:2])]
        expected += [(*row, *r) for r in found] or ([(*row, None, None, None)] if how == "left" else [])
    a = spark.createDataFrame(left, "id int, a string, b int").repartition(6)
    b = spark.createDataFrame(right, "x string, y int, sk int")
    joined = lookup_join(a, b, {"a": "x", "b": "y"}, how, null_safe, limit, rows_per_task=100)
    assert rows(joined) == sorted(expected, key=repr)


def test_hot_keys_are_spread(spark, with_conf):
    with_conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    left = spark.createDataFrame(_skewed(spark), "id int, a string, b int").repartition(6)
    right = spark.createDataFrame([("hot", 1, 10)], "x string, y int, sk int")
    hot = {(r[0], r[1]): r[2] for r in hot_keys(left, ["a", "b"], 100).collect()}
    assert hot == {("hot", 1): 10, (None, 1): 8}
    joined = salted_join(left, right, {"a": "x", "b": "y"}, "left", rows_per_task=100)
    share = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).collect()[0][0]
    assert share < 900  # of 3000; unsalted, 1000 rows of one key would share a task with others


def test_copies_of_one_row_are_spread_over_tasks(spark, with_conf):
    with_conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    left = spark.range(8000, numPartitions=32).select(F.lit("same").alias("a"))
    right = spark.createDataFrame([("same", 1)], "x string, sk int")
    joined = salted_join(left, right, {"a": "x"}, rows_per_task=100)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 4000


def test_broadcast_follows_the_measured_size(spark):
    fact = spark.range(1000).selectExpr("id % 10 as k", "id as v")
    dim = spark.range(10).selectExpr("id", "id + 1 as sk")
    size = profile_lookup(dim.selectExpr("id as _dim_0", "sk as _sk"), ["_dim_0"]).size_bytes
    small = resolve_fk(fact, dim, {"k": "id"}, "sk", max_broadcast_bytes=size)
    large = resolve_fk(fact, dim, {"k": "id"}, "sk", max_broadcast_bytes=size - 1)
    assert "BroadcastHashJoin" in plan(small) and "Exchange hashpartitioning" not in plan(small)
    assert "_salt" in plan(large)
    assert rows(small) == rows(large)
    link = Lookup(dim, {"k": "id"}, "sk", max_broadcast_bytes=size - 1)
    assert link.moves_fact and not Lookup(dim, {"k": "id"}, "sk").moves_fact


def test_multiplied_rows_are_refused_unless_trusted(spark):
    fact = spark.createDataFrame([("P",), (None,)], "party string")
    dim = spark.createDataFrame([("P", 1), ("P", 2), (None, 3), (None, 4)], "sigla string, sk int")
    with pytest.raises(ValueError, match="2 rows"):
        resolve_fk(fact, dim, {"party": "sigla"}, "sk")
    trusted = resolve_fk(fact, dim, {"party": "sigla"}, "sk", unique="trust")
    assert rows(trusted) == [("P", 1), ("P", 2), (None, None)]


def test_cast_modes(spark):
    fact = spark.createDataFrame([("57",), ("x",), (None,), ("99",)], "leg string")
    dim = spark.sql("select cast(57 as smallint) as id, 1L as sk")
    assert rows(resolve_fk(fact, dim, {"leg": "id"}, "sk", cast="lenient")) == [
        ("57", 1), ("99", None), ("x", None), (None, None)
    ]
    with pytest.raises(PySparkException):
        resolve_fk(fact, dim, {"leg": "id"}, "sk").collect()
    inner = resolve_fk(fact, dim, {"leg": "id"}, "sk", how="inner", cast="lenient")
    assert rows(inner) == [("57", 1)]
    for wrong in ({"cast": "other"}, {"unique": "other"}, {"how": "outer"}):
        with pytest.raises(ValueError):
            resolve_fk(fact, dim, {"leg": "id"}, "sk", **wrong)


def test_computed_keys_equal_the_stored_dimension(spark):
    fact = spark.createDataFrame([("a", "1"), ("a", None), ("b", "2"), (None, "2"), ("a", "1")], "n string, t string")
    dim = dimension_from_fact(fact, ["n", "t"], "sk", "hash64")
    for null_safe in (False, True):
        computed = Computed(["n", "t"], "sk", null_safe=null_safe).resolve(fact)
        looked_up = resolve_fk(fact, dim, {"n": "n", "t": "t"}, "sk", null_safe=null_safe)
        assert rows(computed) == rows(looked_up)
        assert "Exchange" not in plan(computed)


def test_dimension_from_fact_keeps_nulls_and_one_row_per_key(spark):
    fact = spark.createDataFrame([("a", "2"), ("a", "1"), (None, "3"), ("a", None)], "n string, t string")
    assert rows(dimension_from_fact(fact, ["n", "t"], "sk").select("n", "t")) == rows(fact)
    by_name = dimension_from_fact(fact, ["n", "t"], "sk", keys=["n"])
    assert rows(by_name.select("n", "t")) == [("a", None), (None, "3")]


def test_fact_keeps_its_rows_and_star_join_columns(spark):
    legs = dimension(spark.range(3).selectExpr("id", "id * 2 as twice"), ["id", "twice"], ["id"], "sk_leg")
    fact = spark.range(20).selectExpr("id % 5 as leg", "id as amount")
    built = build_fact(fact, [Lookup(legs, {"leg": "id"}, "sk_leg")], {"sk_leg": "sk_leg", "value": "amount"})
    assert built.columns == ["sk_leg", "value"] and built.count() == 20
    assert built.filter("sk_leg is null").count() == 8
    known = {r.sk_leg for r in legs.collect()}
    assert {r.sk_leg for r in built.filter("sk_leg is not null").collect()} <= known


def test_link_dimension_drops_used_keys(spark):
    legs = dimension(spark.range(3).toDF("id"), ["id"], ["id"], "sk_leg")
    people = spark.range(4).selectExpr("id as person", "id as last")
    linked = link_dimension(people, [Lookup(legs, {"last": "id"}, "sk_leg")], ["last"])
    assert linked.columns == ["person", "sk_leg"] and linked.count() == 4


def test_join_members_is_inner(spark):
    details = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    members = spark.createDataFrame([(1, [5, 6])], "key int, of array<int>")
    assert rows(join_members(details, members, {"id": "key"})) == [(1, "x", 1, [5, 6])]


def test_another_seed_gets_out_of_a_collision(spark, lake, monkeypatch):
    """Two providers share a hash under seed 0; dimension and fact follow the seed together."""
    from lakestar.operators import keys, star

    real = keys.key_expression

    def colliding(df, natural, method, seed=0):
        return F.lit(7).cast("bigint") if method == "hash64" and seed == 0 else real(df, natural, method, seed)

    monkeypatch.setattr(keys, "key_expression", colliding)
    monkeypatch.setattr(star, "key_expression", colliding)
    expenses = spark.createDataFrame([("a", "1"), ("b", "2")], "nomeFornecedor string, cnpjCpfFornecedor string")
    with pytest.raises(ValueError, match="is not a key"):
        assert_unique_key(gold.dim_provider(expenses), ["sk_fornecedor"])
    dim = assert_unique_key(gold.dim_provider(expenses, seed=1), ["sk_fornecedor"])
    link = star.Computed(gold.PROVIDER_KEY, "sk_fornecedor", seed=1)
    assert rows(link.resolve(expenses).select("nomeFornecedor", "sk_fornecedor")) == rows(dim.select("nomeFornecedor", "sk_fornecedor"))


def test_keys_with_nulls_are_spread_without_salts(spark, with_conf):
    with_conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    left = spark.range(8000, numPartitions=8).selectExpr("cast(null as string) as a", "id")
    right = spark.createDataFrame([("same", 1)], "x string, sk int")
    joined = salted_join(left, right, {"a": "x"}, rows_per_task=10**9)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 2000


def test_parties_that_share_a_code(spark):
    parties = spark.createDataFrame([("A", "z", 1), ("A", "b", 2), ("B", "c", 3)], "sigla string, nome string, sk_partido int")
    parties = parties.selectExpr("sigla", "nome", "null as situacao", "null as total_membros", "null as total_posse", "null as urlLogo", "sk_partido")
    legislatures = spark.createDataFrame([(57, 1)], "id int, sk_legislatura int")
    people = spark.createDataFrame([(1, 57, "A"), (2, 57, "B")], "id int, id_ultima_legislatura int, ultima_filiacao string")
    with pytest.raises(ValueError, match="rows per"):
        gold.linked_deputies(people, legislatures, parties).collect()
    linked = gold.linked_deputies(people, legislatures, parties, shared_codes="first")
    assert rows(linked.select("id", "sk_partido")) == [(1, 2), (2, 3)]


def test_pruning_keeps_every_match_and_few_others(spark):
    left = spark.range(20_000).selectExpr("id", "if(id % 4 = 0, null, concat('k', id % 9000)) as a", "cast(id % 3 as int) as b")
    right = spark.range(300).selectExpr("concat('k', id * 7) as x", "1 as y", "id as sk").union(spark.sql("select null, 1, 0L"))
    matching = left.join(right, (left.a == right.x) & (left.b == right.y), "left_semi")
    kept = pruned(left, right, {"a": "x", "b": "y"}, 301)
    assert matching.exceptAll(kept).isEmpty() and kept.exceptAll(left).isEmpty()
    assert kept.count() < matching.count() + 0.03 * left.count()
    assert "Python" not in plan(kept) and "Nested" not in plan(kept) and "Cartesian" not in plan(kept)
    plain = lookup_join(left, right, {"a": "x", "b": "y"}, "inner", max_broadcast_bytes=-1)
    assert rows(lookup_join(left, right, {"a": "x", "b": "y"}, "inner", max_broadcast_bytes=-1, prune=True)) == rows(plain)


def test_pruning_leaves_out_nothing_it_can_not_judge(spark, monkeypatch):
    left, right = spark.range(50).toDF("a"), spark.range(3).toDF("x")
    assert pruned(left, right.limit(0), {"a": "x"}, 0).count() == 0
    assert pruned(left, right.selectExpr("cast(x as int) as x"), {"a": "x"}, 3) is left
    assert bloom_words(right, ["x"], 10**9, max_bytes=1024) is None
    assert rows(lookup_join(left, right, {"a": "x"}, "left", max_broadcast_bytes=-1, prune=True)) == sorted([(i, i if i < 3 else None) for i in range(50)], key=repr)
