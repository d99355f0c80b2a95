import pyarrow as pa

from replylens.llm import common


def test_a_few_rows_of_a_batch_are_python_objects_at_a_time(spark):
    rows = 2 * common.SLICE + 7

    def make():
        def accept(numbers):
            assert len(numbers) <= common.SLICE
            return [n % 3 == 0 for n in numbers]

        return accept

    kept = common.filter_batches(spark.range(0, rows, 1, 1), "id", make).collect()
    assert [r["id"] for r in kept] == list(range(0, rows, 3))
    values = pa.array([*range(rows), None])
    assert list(common.each_value(values)) == values.to_pylist()
    assert list(common.each_value(values[:0])) == []
