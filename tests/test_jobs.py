"""End-to-end jobs on the fixture inputs."""

import os

from rankloom import jobs
from tests.test_links import LINES
from tests.test_series import EXPECTED, READINGS


def _lines(path):
    out = []
    for f in sorted(os.listdir(path)):
        if f.startswith("part-"):
            out += open(os.path.join(path, f)).read().splitlines()
    return out


def test_rank_job(spark, tmp_path):
    src = tmp_path / "pages.txt"
    src.write_text("\n".join(LINES) + "\n")
    jobs.rank_pages(spark, str(src), str(tmp_path / "out"), preset="total", k=2)
    top = [line.split("\t") for line in _lines(str(tmp_path / "out" / "top2"))]
    assert [n for n, _ in top] == ["GH", "B"]  # GH takes all of F's rank; B ties C, name breaks it
    ranks = {n: float(r) for n, r in (line.split("\t") for line in _lines(str(tmp_path / "out" / "ranks")))}
    assert set(ranks) == {"A", "F", "K", "B", "C", "GH"}
    assert abs(sum(ranks.values()) - 1.0) < 1e-9
    assert sorted(ranks.values(), reverse=True)[:2] == sorted((float(r) for _, r in top), reverse=True)


def test_jobs_side_by_side_leave_their_outputs_only(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from tests.test_rank_fixture import made_by_us

    src = tmp_path / "pages.txt"
    src.write_text("\n".join(LINES) + "\n")
    before, width = made_by_us(spark), spark.conf.get("spark.sql.shuffle.partitions")
    with ThreadPoolExecutor(2) as pool:
        jobs_ = [pool.submit(jobs.rank_pages, spark, str(src), str(tmp_path / p), preset=p, k=3) for p in ("total", "list")]
        [j.result() for j in jobs_]
    assert made_by_us(spark) == before and spark.conf.get("spark.sql.shuffle.partitions") == width
    for p in ("total", "list"):
        assert len(_lines(str(tmp_path / p / "top3"))) == 3 and len(_lines(str(tmp_path / p / "ranks"))) == 6


def test_series_job(spark, tmp_path):
    src = tmp_path / "r.csv"
    src.write_text(READINGS)
    jobs.station_series(spark, str(src), str(tmp_path / "out"))
    assert sorted(_lines(str(tmp_path / "out"))) == EXPECTED


def test_command_line(spark, tmp_path):
    src = tmp_path / "r.csv"
    src.write_text(READINGS)
    jobs.main(["series", str(src), str(tmp_path / "cli")])
    assert sorted(_lines(str(tmp_path / "cli"))) == EXPECTED
    pages = tmp_path / "pages.txt"
    pages.write_text("\n".join(LINES) + "\n")
    jobs.main(["rank", str(pages), str(tmp_path / "rank"), "--preset", "list", "--k", "3"])
    top = [line.split("\t")[0] for line in _lines(str(tmp_path / "rank" / "top3"))]
    assert len(top) == 3 and set(top) <= {"A", "F", "K", "B", "C", "GH"}
