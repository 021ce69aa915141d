import pytest

from bazaarframe.session import partitions_for, size_for


def test_partitions_may_grow_with_the_input():
    assert partitions_for(100 << 40, most_partitions=200_000)[0] == 200_000
    assert partitions_for(100 << 40, 1 << 30, 200_000)[0] == 100 << 10
    assert partitions_for(0, 1 << 20, 10)[0] == 1


def test_a_partition_stands_for_the_same_input_at_every_size():
    assert [partitions_for(n << 20)[0] for n in (160, 1600, 9600)] == [10, 100, 600]
    assert partitions_for(100 << 30)[0] == 2000  # no more than show hot keys without further settings
    assert partitions_for(1 << 40)[0] == 8192


@pytest.mark.parametrize(
    "name, own, finer",
    [("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m", "1m"), ("spark.sql.files.maxPartitionBytes", "128m", "1g")],
)
def test_tasks_get_what_fits_their_memory_unless_the_session_says_otherwise(spark, tmp_path, name, own, finer):
    before = spark.conf.get(name, None)
    try:
        for setting, wanted in ((own, str(16 << 20)), (finer, finer)):
            spark.conf.set(name, setting)
            for _ in range(2):
                size_for(spark, str(tmp_path))
                assert spark.conf.get(name) == wanted
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
