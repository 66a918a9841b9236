"""Randomised check of the watermark filter and advance against a plain
statement of the rules (text order, strictly newer, blank always new and
never advancing, untouched without new events)."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clipstar.operators import incremental as inc

RUN = "2025-03-04 06:00:00"
STAMPS = ["2025-02-01T00:00:00.000Z", "2025-02-01T00:00:00Z", "2025-02-02T10:00:00.000Z",
          "2025-02-03T00:00:00.000Z", "", None]
MEDIA = ["m1", "m2", "m3"]


def model(candidates, checkpoint, processed):
    new, wm = [], dict(checkpoint)
    for media, key, at in candidates:
        mark = checkpoint.get(media)
        if not mark or not at or at > mark:
            new.append(key)
    advanced = dict(checkpoint)
    for media in processed:
        latest = checkpoint.get(media)
        got_new = False
        for m, key, at in candidates:
            if m == media and key in new:
                got_new = True
                if at and (not latest or at > latest):
                    latest = at
        if got_new:
            advanced[media] = latest
        elif media not in advanced:
            advanced[media] = None
    return sorted(new), advanced


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cands=st.lists(st.tuples(st.sampled_from(MEDIA), st.sampled_from(STAMPS)), max_size=8),
       marks=st.dictionaries(st.sampled_from(MEDIA), st.sampled_from(STAMPS), max_size=3),
       processed=st.lists(st.sampled_from(MEDIA), min_size=1, max_size=3, unique=True))
def test_filter_and_advance_match_the_rules(spark, cands, marks, processed):
    rows = [(m, f"k{i}", at) for i, (m, at) in enumerate(cands)]
    c = spark.createDataFrame(rows, "media_id string, event_key string, received_at string")
    cp = spark.createDataFrame([(m, w, None) for m, w in marks.items()],
                               "media_id string, last_event_received_at string, "
                               "last_ingested_at timestamp_ntz")
    media = spark.createDataFrame([(m,) for m in processed], "media_id string")
    # Candidates of unprocessed media are not fetched by the run.
    c = inc.restrict_to(c, media)
    rows = [r for r in rows if r[0] in processed]
    new = inc.new_events(c, cp)
    want_new, want_cp = model(rows, marks, processed)
    assert sorted(r.event_key for r in new.collect()) == want_new
    got = {r.media_id: r.last_event_received_at
           for r in inc.advance_checkpoint(cp, media, new, RUN).collect()}
    assert got == want_cp
