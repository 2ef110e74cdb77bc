import xxhash
from pyspark.sql import functions as F

from tests.conftest import rows
from trilayer.sources import synth
from trilayer.sources.calendar import build_date_dim, build_income_bands, build_time_dim

def test_draws_are_the_public_hash(spark):
    """Independent check of the hash with the xxhash package."""
    made = synth.synth_table(spark, {"v": synth.whole(0, 1000)}, 50).collect()
    import zlib

    def hashed(words):
        h = 42
        for w in words:
            h = xxhash.xxh64_intdigest(w.to_bytes(8, "little"), seed=h)
        return h - (1 << 64) if h >= 1 << 63 else h

    assert [r.v for r in made] == [hashed([42, zlib.crc32(b"v"), 0, i]) % 1000 for i in range(50)]


def test_ranges_weights_and_nulls(spark):
    df = synth.synth_table(spark, {
        "n": synth.some_null(synth.whole(1, 101)), "m": synth.amount(-1, 1), "w": synth.pick("Y", "N", weights=(0.05, 0.95)),
    }, 20_000)
    got = df.agg(
        F.count("n"), F.min("n"), F.max("n"), F.min("m"), F.max("m"), F.count_if(F.col("w") == "Y")
    ).first()
    assert 0.04 < 1 - got[0] / 20_000 < 0.06 and (got[1], got[2]) == (1, 100)
    assert (got[3], got[4]) == (-1.0, 1.0) and 0.04 < got[5] / 20_000 < 0.06


def test_numbers_longer_than_the_width_stay_whole(spark):
    made = spark.createDataFrame([(1_234_566,), (4,)], f"{synth.ROW} bigint").select(synth.numbered(1, "P", 6)(F.col(synth.ROW), None).alias("id"))
    assert rows(made) == [("P000005",), ("P1234567",)]


def test_a_sample_is_never_short(spark):
    parent = spark.range(100_000).select((F.col("id") % 10).alias("k"))
    assert synth.sample_keys(parent, "k", "k", 1000, 100_000).count() == 1000


def test_date_dim(spark):
    from datetime import date

    df = build_date_dim(spark, date(1998, 1, 1), 73_049, today=date(1998, 3, 4))
    assert df.count() == 73_049
    got = {str(r.d_date): r for r in df.where("d_year = 1998").collect()}
    first, leap = got["1998-01-01"], df.where("d_date = '2000-12-31'").first()
    assert (first.d_date_sk, first.d_date_id, first.d_month_seq, first.d_week_seq, first.d_quarter_seq) == (2415022, "AAAAAA19980101", 1177, 1, 1)
    assert (first.d_dow, first.d_day_name, first.d_quarter_name, first.d_holiday) == (3, "Thursday", "1998Q1", "Y")
    assert (first.d_same_day_ly, first.d_same_day_lq) == (2414657, 2414931)
    assert (leap.d_week_seq, leap.d_first_dom, leap.d_last_dom) == (366 // 7 + 1, 336, 1)
    assert got["1998-01-02"].d_following_holiday == "Y"
    assert sum(r.d_current_week == "Y" for r in got.values()) == 7
    assert [got[d].d_current_month for d in ("1998-03-01", "1998-04-01")] == ["Y", "N"]


def test_time_dim_and_bands(spark):
    clock = {r.t_time: r for r in build_time_dim(spark).where("t_time in (0, 28799, 43200, 86399)").collect()}
    assert [(clock[t].t_hour, clock[t].t_minute, clock[t].t_second, clock[t].t_am_pm, clock[t].t_shift) for t in sorted(clock)] == [
        (0, 0, 0, "AM", "first"), (7, 59, 59, "AM", "first"), (12, 0, 0, "PM", "second"), (23, 59, 59, "PM", "third"),
    ]
    assert clock[0].t_time_id == "T00000000"
    assert rows(build_income_bands(spark, 3, 10)) == [(1, 0, 10), (2, 10, 20), (3, 20, 30)]
