import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.session import clear_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", 4)
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    clear_scratch(session)
    session.stop()


def date(text):
    return None if text is None else dt.date.fromisoformat(text)


@pytest.fixture(scope="session")
def frame(spark):
    def make(schema, *rows):
        """Rows as tuples; ISO text becomes a date in date columns."""
        from pyspark.sql import types as T

        parsed = T._parse_datatype_string(schema)
        kinds = [f.dataType for f in parsed.fields]
        cast = [
            tuple(date(v) if isinstance(k, T.DateType) else v for v, k in zip(r, kinds)) for r in rows
        ]
        return spark.createDataFrame(cast, parsed)

    return make


def rows(df, *cols):
    """Rows as plain tuples with dates as text, sorted."""
    picked = df.select(*cols) if cols else df
    out = [
        tuple(v.isoformat() if isinstance(v, dt.date) else v for v in r) for r in picked.collect()
    ]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))
