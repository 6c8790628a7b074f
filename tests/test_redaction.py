"""Masking, hashing and the redaction check."""

import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from outagelens.functions import fixed_values as fixed
from outagelens.functions import redaction
from outagelens.operators import redact

CASES = [
    ("write to a.b+c@mail.example.com now", "write to [EMAIL_REDACTED] now"),
    ("call +1 (555) 123-4567 or 555.123.4567", "call +[PHONE_REDACTED] or [PHONE_REDACTED]"),
    ("ssn 123-45-6789 and 123456789", "ssn [SSN_REDACTED] and [SSN_REDACTED]"),
    ("host 10.0.0.1 down", "host [IP_ADDRESS] down"),
    ("Al Bo met Anna Berg", "Al Bo met [NAME_REDACTED]"),
    ("at Site-Floor-12 in Room 7", "at Site-[FLOOR_REDACTED] in Room [REDACTED]"),
    ("käse@x.de", "käse@x.de"),
    ("Anna Bergä and äAnna Berg", "Anna Bergä and äAnna Berg"),
    ("", ""),
    ("nan", "nan"),
    ("None", "None"),
    (None, None),
]


def by_rules(text):
    for _, pattern, mask in fixed.REDACTION_STEPS:
        text = re.sub(pattern, mask, text)
    return text


def test_cases(values):
    assert values(redaction.redact_text("t"), "t string", [t for t, _ in CASES]) == [e for _, e in CASES]
    assert [t if t is None else by_rules(t) for t, _ in CASES] == [e for _, e in CASES]


pieces = st.sampled_from(
    ["Anna Berg", "anna", "a.b@x.de", "@", "x|y@q.a|b", "555-123-4567", "(555)1234567", "+1 ", "123-45-6789", "10.1.2.3",
     "-Floor-9", "Room 12", "Room\n3", "ä", "É", "ß", "_", ".", " ", "-", "1", "99", "Z", "\t", "4567 ", "é@x.com"]
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(pieces, max_size=12).map("".join), min_size=80, max_size=80))
def test_matches_the_rules_on_any_text(values, texts):
    assert values(redaction.redact_text("t"), "t string", texts) == [by_rules(t) for t in texts]


def test_counts(values):
    rows = ["a@x.de b@y.com", "none", None, "é a@x.de"]
    assert values(redaction.count_hits("t", "email"), "t string", rows) == [2, 0, 0, 1]
    assert values(redaction.count_hits("t", "phone"), "t string", ["5551234567 555-123-4567"]) == [2]


def test_hash(values):
    expected = "HASH_" + hashlib.sha256(b"pepper_INC0010001").hexdigest()[:12].upper()
    rows = ["INC0010001", "", "nan", "NONE", None]
    assert values(redaction.hash_id("i", "pepper"), "i string", rows) == [expected, "", "nan", "NONE", None]


def test_locations(values):
    rows = ["70012 - Bursa - Turkey / Depot 7 (Wing B)", "Depot-7-Hall-C", None]
    assert values(redaction.location_country("l"), "l string", rows) == ["Turkey", "Depot-7-Hall-C", None]
    assert values(redaction.location_prefix("l"), "l string", rows) == ["70012 ", "Depot", None]


def frame(spark):
    return spark.createDataFrame(
        [("INC1", "s1", "mail a@x.de", "Anna Berg 555-123-4567", "a@x.de", "Anna"), ("INC2", "s2", None, "ok", "b@x.de", None)],
        "number string, sys_id string, short_description string, description string, caller_id string, assigned_to string",
    )


def test_frame_defaults(spark):
    out = redact.redact_frame(frame(spark), "pepper")
    assert out.columns == ["number", "sys_id", "short_description", "description", "number_hash", "sys_id_hash"]
    rows = {r.number: r for r in out.collect()}
    assert rows["INC1"].short_description == "mail [EMAIL_REDACTED]"
    assert rows["INC1"].description == "[NAME_REDACTED] [PHONE_REDACTED]"
    assert rows["INC2"].short_description is None


def test_frame_can_drop_raw_ids(spark):
    out = redact.redact_frame(frame(spark), "pepper", drop_raw_ids=True)
    assert "number" not in out.columns and "number_hash" in out.columns


def test_replace_id(spark):
    out = redact.redact_replace_id(frame(spark), "pepper")
    assert "id_hash" in out.columns and not {"number", "caller_id"} & set(out.columns)


def test_validation(spark):
    df = frame(spark)
    row = redact.validate_redaction(df, redact.redact_frame(df, "pepper")).first()
    assert (row.email_count_original, row.phone_count_original) == (3, 1)
    assert (row.email_count_redacted, row.phone_count_redacted, row.redaction_successful) == (0, 0, True)
    row = redact.validate_redaction(df, df).first()
    assert row.redaction_successful is False


def test_column_scan(spark):
    rows = {r.column_name: r for r in redact.pii_column_scan(frame(spark)).collect()}
    assert rows["caller_id"].sensitive_by_name and rows["caller_id"].email_hits == 2
    assert not rows["description"].sensitive_by_name and rows["description"].phone_hits == 1
