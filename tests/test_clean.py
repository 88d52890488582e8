import datetime as dt

from conftest import raw_frame, row

from pricelake.operators import clean
from pricelake.schema import CLEAN_COLUMNS, Config

CFG = Config(min_year=2013, max_year=2025)


def _reasons(spark, rows):
    df = clean.with_reject_reason(raw_frame(spark, rows), CFG)
    return [r["reject_reason"] for r in df.collect()]


def test_trap_rows_reject_reasons(spark):
    rows = [
        row(state=" PUNJAB ", commodity="Tur (Arhar)"),
        row(arrival_date="1/2/2020"),
        row(arrival_date="2020-02-01"),
        row(arrival_date="31/02/2020"),
        row(max_price=float("nan"), modal_price=float("nan")),
        row(commodity="   "),
        row(state=""),
        row(state="  "),
        row(arrival_date="28/02/2020", min_price=None),
        row(arrival_date="29/02/2020", min_price=-1.0),
        row(min_price=30.0, max_price=20.0),
        row(arrival_date="01/02/2012"),
        row(modal_price=None),
        row(market=None),
        row(modal_price=float("inf"), max_price=float("inf")),
    ]
    assert _reasons(spark, rows) == [
        None,
        "bad_date",
        "bad_date",
        "bad_date",
        "non_finite_price",
        "missing_critical",
        None,
        None,
        "invalid_price",
        "invalid_price",
        "invalid_price",
        "year_out_of_range",
        "missing_critical",
        "missing_critical",
        "non_finite_price",
    ]


def test_clean_values_and_casing(spark):
    rows = [row(state=" PUNJAB ", commodity="Tur (Arhar)", district="jammu and kashmir"), row(state="  ")]
    out = clean.clean_records(raw_frame(spark, rows), CFG).collect()
    assert len(out) == 2
    first = out[0].asDict()
    assert first["state"] == "Punjab"
    assert first["commodity"] == "Tur (arhar)"
    assert first["district"] == "Jammu And Kashmir"
    assert first["arrival_date"] == dt.date(2020, 2, 1)
    assert (first["year"], first["month"]) == (2020, 2)
    assert out[1]["state"] is None
    assert list(out[0].asDict()) == list(CLEAN_COLUMNS)


def test_modal_outside_range_is_kept(spark):
    out = clean.clean_records(raw_frame(spark, [row(modal_price=99.0)]), CFG)
    assert out.count() == 1


def test_audit_counts_add_up(spark):
    rows = [row(), row(arrival_date="bad"), row(commodity=None), row(min_price=0.0), row()]
    audit = {r["reject_reason"]: r["record_count"] for r in clean.clean_audit(raw_frame(spark, rows), CFG).collect()}
    assert audit == {"kept": 2, "bad_date": 1, "missing_critical": 1, "invalid_price": 1}
    totals = clean.audit_totals(clean.clean_audit(raw_frame(spark, rows), CFG)).collect()[0]
    assert (totals.raw_count, totals.clean_count, totals.dropped_count) == (5, 2, 3)
    assert abs(totals.dropped_pct - 60.0) < 1e-9


def test_observation_matches_audit(spark):
    rows = [row(), row(arrival_date="bad"), row(commodity=None), row(min_price=0.0), row(modal_price=99.0)]
    cleaned, obs = clean.clean_with_observation(raw_frame(spark, rows), CFG)
    assert cleaned.count() == 2
    m = obs.get
    assert m["raw_count"] == 5 and m["kept"] == 2 and m["bad_date"] == 1
    assert m["missing_critical"] == 1 and m["invalid_price"] == 1 and m["modal_outside_range"] == 1
    assert sum(m[r] for r in clean.REJECT_REASONS) + m["kept"] == m["raw_count"]


def test_single_steps(spark):
    df = raw_frame(spark, [row(), row(commodity=" "), row(min_price=-1.0), row(arrival_date="2020-01-01")])
    assert clean.critical_filter(df).count() == 3
    assert clean.valid_prices(df).count() == 3
    assert clean.parse_dates(df).count() == 3
    assert clean.normalise_text(df).count() == 4
