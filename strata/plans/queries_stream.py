"""Registered streaming query: late corrections processed by Structured
Streaming (``foreachBatch``) on top of a baseline publication."""

from __future__ import annotations

from strata.plans import feeds as fd
from strata.plans import oracle as o
from strata.plans import scenarios as sc
from strata.plans.queries import register
from strata.session import shared_dir
from strata.streaming.corrections import CorrectionStream

@register("stream_late", o.case_ctes("late") + "SELECT * FROM mart")
def q_stream_late(spark, sf_dir):
    """Publish the baseline mart, stream the late-correction slice (derived
    from ``events`` and landed as Parquet files), let every micro-batch
    republish the days its keys touch; the published table then equals the
    batch run that includes the corrections."""
    events = fd.read_table(spark, sf_dir, "events")
    root = shared_dir(spark, "stream-late")
    cs = CorrectionStream(spark, f"{root}/versions", f"{root}/published", fd.user_history(events),
                          fd.VALUE_CLASSES, fd.FACT_TYPES, source_system=fd.EVENTS_SOURCE)
    cs.seed(fd.events_typed(events))
    cs.publish_all(*fd.event_bounds(events), run_id="baseline")
    return _streamed(cs, sc.late_delta(events), root)


def _streamed(cs: CorrectionStream, delta, root: str):
    delta.write.mode("overwrite").parquet(f"{root}/inbox")
    q = cs.start_typed(f"{root}/inbox", delta.schema, f"{root}/stream-checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"correction stream failed: {q.exception()}")
    return cs.publisher.live()


@register("stream_moved", o.elt_ctes(typed=f"""SELECT * FROM ({o.typed_events()}) a UNION ALL
  SELECT * REPLACE (TIMESTAMP {o.q(sc.LATE_UPDATED)} AS updated_ts) FROM ({o.typed_events(
      slice_id='moved', order=1, synthetic=True, table="""(SELECT * REPLACE (CASE
        WHEN CAST(ts AS DATE) + 3 <= (SELECT max(CAST(ts AS DATE)) FROM events) THEN ts + INTERVAL 3 DAY
        ELSE ts END AS ts) FROM events WHERE event_type = 'click') e""")}) m""") + "SELECT * FROM mart")
def q_stream_moved(spark, sf_dir):
    """Like ``stream_late``, but the corrections move events to a day that is
    not next to their old one: both days must be republished, and each event
    counted once."""
    events = fd.read_table(spark, sf_dir, "events")
    root = shared_dir(spark, "stream-moved")
    cs = CorrectionStream(spark, f"{root}/versions", f"{root}/published", fd.user_history(events),
                          fd.VALUE_CLASSES, fd.FACT_TYPES, source_system=fd.EVENTS_SOURCE)
    cs.seed(fd.events_typed(events))
    cs.publish_all(*fd.event_bounds(events), run_id="baseline")
    return _streamed(cs, sc.moved_delta(events), root)
