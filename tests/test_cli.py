"""The command line, run as a user would: a fresh process outside the repository."""

import os
import subprocess
import sys

from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_end_to_end(tmp_path):
    t = str(tmp_path)
    script = tmp_path / "run.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {REPO!r})
import __spark_entry__ as ent
from wayfare.session import build_session
from wayfare.sinks import publish_events
spark = build_session("local[2]")
ent._events(spark, {SF_SMALL!r}).write.parquet({t!r} + "/events")
lk = ent._lookup(spark, {SF_SMALL!r})
lk.select("iata_code", "iata_code", "city", "country", "iata_code").write.csv({t!r} + "/airports")
from wayfare.sources.fixtures import load_table, raw_rows_from_event_log
raw = raw_rows_from_event_log(load_table(spark, {SF_SMALL!r}, "events")).drop("_ingest_ts")
raw.write.option("header", "true").csv({t!r} + "/raw")
spark.stop()
from wayfare.cli import main
main(["job", "--events", {t!r} + "/events", "--lookup", {t!r} + "/airports", "--target", {t!r} + "/recs",
      "--as-of", "2024-01-31 00:00:00", "--lookback-days", "30", "--evaluate"])
main(["latest", "--recs", {t!r} + "/recs", "--out", {t!r} + "/latest"])
main(["normalize", "--raw", {t!r} + "/raw", "--out", {t!r} + "/lake", "--rejects", {t!r} + "/rejects"])
spark = build_session("local[2]")
publish_events(spark.read.parquet({t!r} + "/lake").drop("event_day"), "text", {t!r} + "/topic", num_files=2)
from wayfare.sources.readers import scan_recommendations
day = scan_recommendations(spark, {t!r} + "/recs").first().generated_at.date().isoformat()
spark.stop()
main(["on-day", "--recs", {t!r} + "/recs", "--day", day, "--out", {t!r} + "/today"])
main(["ingest", "--source", {t!r} + "/topic", "--lake", {t!r} + "/ingested", "--checkpoint", {t!r} + "/ckpt",
      "--max-per-trigger", "1"])
main(["compact", "--lake", {t!r} + "/ingested", "--before", "2100-01-01", "--vacuum"])
spark = build_session("local[2]")
r = lambda p: spark.read.parquet({t!r} + "/" + p).count()
print("COUNTS", scan_recommendations(spark, {t!r} + "/recs").count(), r("latest"), r("today"), r("lake"), r("rejects"), r("ingested"))
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=t, env=env, capture_output=True, text=True,
                         timeout=900)
    line = [x for x in out.stdout.splitlines() if x.startswith("COUNTS")]
    assert line, out.stderr[-3000:]
    recs, latest, today, lake, rejects, ingested = map(int, line[0].split()[1:])
    assert recs == 75 and 0 < latest <= recs and today == latest
    assert lake > 0 and rejects > 0 and ingested == lake
    assert "packed" in out.stdout and "partitions" in out.stdout
