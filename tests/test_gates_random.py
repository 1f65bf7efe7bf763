import math
import random
import re

from orrery.operators import quality
from orrery.sources.csv_files import read_star_csv

COLUMNS = ["source_id", "ra", "dec", "parallax", "parallax_error", "phot_g_mean_mag", "bp_rp"]
ODD = ["", " ", "nan", "-nan", "inf", "-Infinity", "1.0d", "0x1p3", "1e", "5.", ".5", "+7", "-3", "0", "-0.0", "1e400", "9" * 25, "1_0", "abc", " 12 ", "1e-3", "0.01", "0.0099"]


def real(text):
    t = text.strip().lower()
    return float(t) if re.fullmatch(r"[+-]?(inf|infinity|nan|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)", t) else None


def gate(row, snr):
    """The first check that a row fails, in plain Python."""
    id_ = row[0].strip()
    if not re.fullmatch(r"\+?\d+", id_) or int(id_) >= 1 << 63:
        return "source_id", quality.PARSE_FAILURE
    names = ["ra", "dec_deg", "parallax", "parallax_error", "magnitude"]
    values = dict(zip(names, map(real, row[1:6]), strict=True))
    for n in names:
        if values[n] is None:
            return n, quality.PARSE_FAILURE
    plx, err = values["parallax"], values["parallax_error"]
    if plx <= 0:
        return "parallax", quality.NON_POSITIVE
    if err <= 0 or plx / err < snr:
        return "parallax", quality.LOW_SNR
    if not math.isnan(plx) and 1000 / plx > 100_000:
        return "parallax", quality.TOO_FAR
    return None


def test_every_row_is_kept_or_rejected_for_the_right_reason(spark, tmp_path):
    r = random.Random(11)
    good = lambda: str(round(r.uniform(0.001, 50), r.randint(0, 4)))
    rows = [[str(i), *(r.choice(ODD) if r.random() < 0.15 else good() for _ in range(6))] for i in range(1500)]
    for k in range(0, 1500, 40):
        rows[k][0] = r.choice(ODD)
    for part, (a, b) in enumerate(((0, 700), (700, 1500))):
        order = r.sample(range(7), 7)
        lines = [",".join(COLUMNS[c] for c in order)] + [",".join(row[c] for c in order) for row in rows[a:b]]
        (tmp_path / f"part{part}.csv").write_text("\n".join(lines) + "\n")
    parsed = quality.parse_stars(read_star_csv(spark, str(tmp_path)))
    wanted = [gate(row, 5.0) for row in rows]
    log = {(int(x["file"][-5]), x["line"]): (x["field"], x["reason"]) for x in quality.rejects(parsed).collect()}
    places = [(0, k + 2) if k < 700 else (1, k - 700 + 2) for k in range(1500)]
    assert log == {p: w for p, w in zip(places, wanted, strict=True) if w}
    kept = quality.kept_stars(parsed).orderBy("star_ord").collect()
    assert [x["source_id"] for x in kept] == [int(row[0]) for row, w in zip(rows, wanted, strict=True) if not w]
    assert [x["bp_rp"] is None for x in kept] == [real(row[6]) is None for row, w in zip(rows, wanted, strict=True) if not w]
