"""Every input row ends up accepted or rejected, exactly once."""

from stationlake.sources import fixed_width as FW
from stationlake.sources import fixtures as FX
from stationlake.sources import messages as M
from stationlake.sources import observations_csv as OC
from tests.conftest import SF_SMALL


def test_station_lines_partition(spark):
    path = FX.station_file(spark, SF_SMALL)
    parsed = FW.read_stations_fixed_width(spark, path)
    assert FW.accepted(parsed).count() + FW.rejects(parsed).count() == spark.read.text(path).count()


def test_observation_lines_partition(spark):
    path = FX.observation_files(spark, SF_SMALL)
    parsed = OC.read_observations_csv(spark, path)
    total = spark.read.text(path).count()
    assert total == FX.table(spark, SF_SMALL, "lineitem").count()
    assert OC.accepted(parsed).count() + OC.rejects(parsed).count() == total


def test_messages_partition(spark):
    recs = M.read_queue_events(spark, FX.queue_event_dir(spark, SF_SMALL))
    v = M.validate_messages(recs)
    assert recs.count() == FX.table(spark, SF_SMALL, "events").count()
    assert M.accepted(v).count() + M.dead_letters(v).count() == recs.count()
