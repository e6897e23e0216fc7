from salesloom.session import MIB, settings_for


def test_partitions_follow_data_and_cores():
    small = settings_for(10 * MIB, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    large = settings_for(20 * 10**12, 4000)
    assert int(large["spark.sql.shuffle.partitions"]) * 200 * MIB >= 20 * 10**12
    key = "spark.sql.files.maxPartitionBytes"
    assert int(large[key]) > int(small[key])


def test_settings_are_known_to_spark(spark):
    for key, value in settings_for(10 * MIB, 8).items():
        before = spark.conf.get(key)
        spark.conf.set(key, value)
        spark.conf.set(key, before)
