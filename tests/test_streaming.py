import pytest
from conftest import rows

from dosewise import CONTRACTS
from dosewise.session import checkpoint_root
from dosewise.sources.tables import write_table
from dosewise.streaming.append import append_stream, normalised

SCHEMA = "Patient string, Symptom string, date string"
ONE, TWO, THREE = (("p1", "fever", "2021-03-01"), ("p2", "ache", "2021-03-02"), ("p3", "ache", "2021-03-04"))


@pytest.fixture()
def inbox(spark, tmp_path):
    class Inbox:
        path = f"{tmp_path}/inbox"
        table = f"{tmp_path}/diagnosis"

        def deliver(self, *cells):
            spark.createDataFrame(list(cells), SCHEMA).write.mode("append").json(self.path)

        def load(self, table=None, **options):
            raw = spark.readStream.schema(SCHEMA).json(self.path)
            append_stream(raw, CONTRACTS["diagnosis"], table or self.table, **options).awaitTermination()
            return self.read()

        def read(self):
            return rows(spark.read.parquet(self.table))

        def write(self, *cells, keys=()):
            df = spark.createDataFrame(list(cells), SCHEMA.lower())
            df = df.withColumn("date", df.date.cast("date"))
            write_table(df, self.table, keys=keys)

    return Inbox()


def test_new_files_are_appended_once(inbox, tmp_path, spark):
    inbox.deliver(ONE, ("p2", "fever", "2021-02-29"))
    assert inbox.load() == [ONE]
    assert inbox.load() == [ONE]
    inbox.deliver(THREE)
    assert inbox.load() == [ONE, THREE]
    other = f"{tmp_path}/second"
    inbox.load(other)
    assert rows(spark.read.parquet(other)) == [ONE, THREE]


def test_stored_rows_and_streamed_rows_are_all_there(inbox):
    inbox.write(ONE)
    inbox.deliver(TWO)
    assert inbox.load() == [ONE, TWO]
    inbox.write(THREE)
    assert inbox.read() == [ONE, TWO, THREE]


def test_another_spelling_of_the_path_is_the_same_table(inbox):
    inbox.deliver(ONE)
    assert inbox.load() == [ONE]
    inbox.deliver(TWO)
    assert inbox.load(inbox.table + "/") == [ONE, TWO]
    inbox.deliver(THREE)
    assert inbox.load(inbox.table.replace("/diagnosis", "/./diagnosis//")) == [ONE, TWO, THREE]
    assert normalised("s3a://bucket//a/./b/") == "s3a://bucket/a/b"


def test_a_lost_log_and_a_replay_lose_and_double_nothing(inbox, tmp_path):
    inbox.deliver(ONE)
    assert inbox.load(checkpoint=f"{tmp_path}/log1") == [ONE]
    inbox.deliver(TWO)
    # A new log starts at the first file again: it sees old and new rows in one batch.
    assert inbox.load(checkpoint=f"{tmp_path}/log2") == [ONE, TWO]
    assert inbox.load(checkpoint=f"{tmp_path}/log3") == [ONE, TWO]
    inbox.deliver(THREE)
    assert inbox.load(checkpoint=f"{tmp_path}/log1") == [ONE, TWO, THREE]


def test_keyed_append_adds_nothing_twice(inbox, spark):
    key = CONTRACTS["diagnosis"].key
    inbox.write(ONE, TWO, (None, "ache", "2021-03-01"), keys=key)
    inbox.write(ONE, TWO, (None, "ache", "2021-03-01"), keys=key)
    assert len(inbox.read()) == 3
    inbox.write(ONE, THREE, keys=key)
    assert len(inbox.read()) == 4
    inbox.write(ONE)
    assert len(inbox.read()) == 5


def test_checkpoint_folder_is_the_session_setting(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local[2]"])
def test_session_without_checkpoint_folder_is_refused(master):
    class Context:
        pass

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    Session.sparkContext.master = master
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
