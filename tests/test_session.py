"""Stored tables of the shared folder."""

from pathlib import Path

from panelwright.session import result_of, shared_folder, stored


def test_what_was_stored_on_the_way_is_removed(spark):
    def folders():
        return {p.name for p in Path(shared_folder(spark)).glob("panelwright/*/way-*")}

    def make():
        inner = result_of(spark, lambda: stored(before, "way-first").filter("id > 1"), "way-inner")
        assert any(n.startswith("way-inner") for n in folders()) and not any(n.startswith("way-first") for n in folders())
        return stored(inner, "way-second").filter("id < 4")

    before = stored(spark.range(6), "way-before")
    out = result_of(spark, make, "way-out")
    assert sorted(r.id for r in out.collect()) == [2, 3]
    assert sorted(n.rsplit("-", 1)[0] for n in folders()) == ["way-before", "way-out"]
    assert before.count() == 6
