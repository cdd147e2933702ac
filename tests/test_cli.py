import pytest

from helpers import event, messages, record_of
from rillwork import __main__ as cli
from rillwork.plans.jobs import MultiTopicJob
from rillwork.streaming.lookups import CachedLookup


def test_template_from_command_line(spark, tmp_path):
    messages(spark, [event(0)], topic="t").write.parquet(str(tmp_path / "in" / "t"))
    cli.main(["template", "--checkpoint", str(tmp_path / "cp"), "--topic", "t",
              "--output-table", str(tmp_path / "out"), "--replay", str(tmp_path / "in"),
              "--available-now", "--transform", "helpers:record_of"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_options_reach_the_job():
    args = cli.parser().parse_args(
        ["multi", "--checkpoint", "c", "--user-profiles-topic", "p", "--kafka-read-offset",
         "earliest", "--refresh-seconds", "60", "--every", "5 seconds"])
    job = cli.job_from(args)
    assert isinstance(job, MultiTopicJob)
    assert job.refresh_seconds == 60 and job.trigger == {"processingTime": "5 seconds"}
    assert job.kafka_read_offset == "earliest" and job.enriched_events_table is None
    assert cli.job_from(cli.parser().parse_args(
        ["template", "--checkpoint", "c", "--transform", "helpers:record_of"]
    )).transform is record_of
    assert cli.job_from(cli.parser().parse_args(
        ["branched", "--checkpoint", "c", "--separate-scans"])).one_scan is False
    looked = cli.job_from(cli.parser().parse_args(
        ["multi", "--checkpoint", "c", "--lookup", "cached", "--ttl-seconds", "5", "--spread", "7"]))
    assert isinstance(looked.lookup, CachedLookup) and looked.spread == 7
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["other"])
