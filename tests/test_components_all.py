"""Components over all orders, against union-find."""

from loam.plans import registry

registry.load()


def test_components_take_all_orders(spark, tmp_path):
    keys = [2, 3, 4, 9, 13, 18, 24, 40, 44, 100, 101, 9]
    spark.createDataFrame([(k,) for k in keys], "o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for k in keys:
        a, b = find(k), find(k + 7 * (1 + k % 3))
        root[max(a, b)] = min(a, b)
    got = registry.QUERIES["q_components"](spark, str(tmp_path))
    assert sorted((r.node, r.root) for r in got.select("node", "root").collect()) == sorted((x, find(x)) for x in root)
