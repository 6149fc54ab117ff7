import pytest
from conftest import DATA, event
from hypothesis import given, settings, strategies as st, HealthCheck
from pyspark.sql import functions as F

from telemill.config import INVALID, MALFORMED, RuleSet
from telemill.operators import decode, dedup, normalize as no, validate as va
from telemill.plans import batch as plan
from telemill.schema import ANY_OBJECT, EVENT

V, M, I = "valid", MALFORMED, INVALID
CASES = [
    (event(), V),
    ("not json", M),
    ("", M),
    (None, M),
    ("[]", M),
    ("null", M),
    ("17", M),
    ('"text"', M),
    ('{"vehicle_id": "BMW-1", "speed":', M),
    ([event()], M),
    ("{}", I),
    ('{"other": 1}', I),
    ('{"vehicle_id":"BMW-1","timestamp":"2026-09-17T10:30:00Z","speed":1,"battery_level":1,"temperature":1,"fault_code":"NONE"} tail', V),
    (event(speed="70.5"), I),
    (event(speed="fast"), I),
    (event(temperature=float("nan")), I),
    (event(speed=float("inf")), I),
    (event(vehicle_id=42), I),
    (event(vehicle_id=" bmw-42 "), V),
    (event(vehicle_id="BMW-"), I),
    (event(vehicle_id="CAR-1"), I),
    (event(vehicle_id="\tBMW-1"), I),
    (event(vehicle_id="BMW-1\n"), I),
    (event(vehicle_id=None), I),
    (event(vehicle_id=...), I),
    (event(timestamp="2026-09-17T10:30:00Z"), V),
    (event(timestamp="2026-09-17T10:30:00.123456-05:30"), V),
    (event(timestamp="2026-09-17T10:30:00"), I),
    (event(timestamp="2026-09-17T10:30:00+0000"), I),
    (event(timestamp="10:30:00Z"), I),
    (event(timestamp="not-a-date"), I),
    (event(timestamp="2026-02-30T10:30:00Z"), I),
    (event(speed=0), V),
    (event(speed=250), V),
    (event(speed=250.01), I),
    (event(speed=-0.01), I),
    (event(battery_level=0), V),
    (event(battery_level=100), V),
    (event(battery_level=100.5), I),
    (event(temperature=-20), V),
    (event(temperature=120), V),
    (event(temperature=-20.5), I),
    (event(temperature=...), I),
    (event(fault_code="temp-high"), V),
    (event(fault_code=" engine_fault "), V),
    (event(fault_code="temphigh"), I),
    (event(fault_code=None), I),
    (event(fault_code=""), I),
]


def test_strict_outcome_of_every_payload(records):
    flagged = va.flag_events(records([p for p, _ in CASES]), carry=["offset"])
    got = {r.offset: r.error_reason or V for r in flagged.collect()}
    wrong = {str(p): (got[i], want) for i, (p, want) in enumerate(CASES) if got[i] != want}
    assert not wrong
    assert len(got) == len(CASES)


def test_every_record_is_either_valid_or_dead(records):
    flagged = va.flag_events(records([p for p, _ in CASES]))
    valid, dead = va.valid_events(flagged), va.dead_letter(flagged)
    assert valid.count() + dead.count() == len(CASES)
    assert va.malformed_events(flagged).count() + va.invalid_events(flagged).count() == dead.count()


def test_compat_counts_only_empty_payloads_as_malformed(records):
    raw = records([p for p, _ in CASES] + ["  "])
    flagged = va.flag_events(raw, compat=True)
    literal = raw.filter(F.from_json(F.col("value").cast("string"), EVENT).isNull()).count()
    assert literal == flagged.filter(F.col("error_reason") == MALFORMED).count() == 3
    assert flagged.filter("is_valid").count() == sum(1 for _, want in CASES if want == V)


def test_normalised_values(records):
    row = va.valid_events(va.flag_events(records([event(vehicle_id=" bmw-42 ", fault_code=" temp-high ")]))).first()
    assert (row.vehicle_id, row.fault_code) == ("BMW-42", "TEMP_HIGH")
    assert row.event_timestamp.isoformat() == "2026-09-17T10:30:00"


def test_rules_are_configurable(records):
    rules = RuleSet(id_prefix="VAN-", limits={"speed": (0, 90), "battery_level": (0, 100), "temperature": (-20, 120)})
    raw = records([event(), event(vehicle_id="VAN-7"), event(vehicle_id="VAN-7", speed=91)])
    assert [r.is_valid for r in va.flag_events(raw, rules, ["offset"]).orderBy("offset").collect()] == [False, True, False]


def test_strict_path_parses_each_payload_once(records, plan_of):
    plan = plan_of(va.valid_events(va.flag_events(records([event()]))))
    assert plan.count("from_json") == 1


def messages(records, *payloads):
    judged = va.validate_rules(records(list(payloads)), carry=["offset"]).orderBy("offset").collect()
    assert all(r.valid == (not r.errors) for r in judged)
    return [r.errors for r in judged]


def test_rule_messages(records):
    bad = {
        "vehicle_id": "",
        "timestamp": "not-a-date",
        "speed": -5,
        "battery_level": 120,
        "temperature": 150,
        "fault_code": "",
    }
    assert messages(
        records,
        event(),
        bad,
        {"vehicle_id": "BMW-101", "speed": 60},
        event(vehicle_id="not-a-bmw-id", fault_code="UNKNOWN"),
        event(timestamp="2026-09-17T10:30:00", speed="x"),
        event(vehicle_id=None, battery_level=None),
        event(vehicle_id=...),
        event(vehicle_id=" BMW-a7\t", speed=" 70.5 ", fault_code=" none "),
        event(vehicle_id="bmw-7", fault_code="temp-high"),
        event(temperature=float("nan")),
        event(speed="70.5d", timestamp="2026-09-17T10:30:00+0200"),
    ) == [
        [],
        [
            "vehicle_id is null or empty",
            "timestamp is not a valid ISO-8601 datetime",
            "speed is out of expected range 0..250",
            "battery_level is out of expected range 0..100",
            "temperature is out of expected range -20..120",
            "fault_code is invalid",
        ],
        [f"Missing required field: {f}" for f in ("timestamp", "battery_level", "temperature", "fault_code")],
        ["vehicle_id has an invalid format", "fault_code is invalid"],
        ["timestamp must include timezone information", "speed is not numeric"],
        ["vehicle_id is null or empty", "battery_level is not numeric"],
        ["vehicle_id is null or empty"],
        [],
        ["vehicle_id has an invalid format", "fault_code is invalid"],
        ["temperature is out of expected range -20..120"],
        ["speed is not numeric"],
    ]


def test_split_keeps_originals_and_lists_reasons(records):
    judged = va.validate_rules(records([event(vehicle_id=" BMW-1 ", speed="70.5"), event(speed=-1, fault_code="?")]))
    valid, invalid, reasons = va.validate_split(judged)
    row = valid.first()
    assert (valid.count(), row.vehicle_id, row.speed) == (1, "BMW-1", 70.5)
    assert '"fault_code": "?"' in invalid.first().json_payload
    assert sorted(r.reason for r in reasons.collect()) == ["fault_code is invalid", "speed is out of expected range 0..250"]
    counts = {r.reason: r.occurrences for r in va.dq_reason_counts(judged).collect()}
    assert counts == {"fault_code is invalid": 1, "speed is out of expected range 0..250": 1}


def test_single_pass_split_has_the_same_parts(records):
    judged = va.validate_rules(records([p for p, _ in CASES]), carry=["offset"])
    valid, invalid, reasons = va.validate_split(judged, ["offset"])
    rows = va.split_rows(judged, ["offset"])

    def part(name):
        return sorted(((r.offset, r.content) for r in rows.filter(F.col("part") == name).collect()), key=str)

    assert part("valid") == sorted(((r.offset, r.vehicle_id) for r in valid.collect()), key=str)
    assert part("invalid") == sorted(((r.offset, r.json_payload) for r in invalid.collect()), key=str)
    assert part("reason") == sorted(((r.offset, r.reason) for r in reasons.collect()), key=str)


def test_invalid_counts_per_batch(records):
    flagged = va.flag_events(records([event(), "x", event(speed=-1)], [0, 0, 1]), carry=["batch_id"])
    assert {r.batch_id: r.invalid_records for r in va.invalid_counts(flagged).collect()} == {0: 1, 1: 1}


FRAGMENTS = st.lists(
    st.sampled_from(
        ['{', '}', '[', ']', ',', ':', '"vehicle_id"', '"speed"', '"BMW-1"', '1', '-2.5', 'null', 'true', 'NaN', ' ', 'x',
         '{"vehicle_id": "BMW-1"', '"fault_code": "NONE"', '{"speed": 3}']
    ),
    max_size=8,
).map("".join)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(FRAGMENTS, min_size=60, max_size=60))
def test_skipping_the_second_parse_never_changes_what_is_malformed(records, payloads):
    decoded = decode.flatten_event(decode.decode_payload(records(payloads)))
    always = F.from_json("json_payload", ANY_OBJECT).isNull()
    assert decoded.filter(decode.is_malformed() != always).count() == 0


def test_lenient_plans_parse_the_fields_once(records, plan_of):
    raw = records([event()])
    judged = va.validate_rules(raw)
    for frame in (judged, va.dq_reason_counts(judged), no.normalize_events(raw)):
        # one for the fields, one for rows with a null, whatever they are used for
        assert plan_of(frame).count("from_json") == 2


def test_of_a_repeated_key_the_last_value_holds(records):
    raw = records(['{"a":1,"a":2}', '{"a":2}', '{"b":1,"a":1,"b":3}', '{"a":1,"b":3}', '{"a":2,"c":null}'])
    rows = dedup.exact_dedup_payloads(decode.decode_payload(raw)).collect()
    assert sorted(sorted(r.fields.items(), key=str) for r in rows) == [
        [("a", "1"), ("b", "3")], [("a", "2")], [("a", "2"), ("c", None)]
    ]


def test_records_that_differ_in_another_key_are_different(records):
    raw = records([event(seq=1), event(seq=2), event(seq=2)])
    assert plan.rule_checked_summaries(raw).first().event_count == 2


def test_plan_has_no_exchange_but_dedup_and_aggregate(spark, plan_of):
    from telemill.plans.registry import QUERIES

    assert plan_of(QUERIES["window_kpis"](spark, DATA)).count("Exchange hashpartitioning") == 2
    assert "Exchange" not in plan_of(QUERIES["decode_payload"](spark, DATA))
