import pytest

from playstream import model


def test_parents_are_loaded_before_children():
    names = [t.name for t in model.load_order(reversed(model.DIMENSIONS))]
    assert names.index("artists") < names.index("albums")
    assert sorted(names) == sorted(t.name for t in model.DIMENSIONS)


def test_a_cycle_of_references_is_refused():
    one = model.Table("one", model.USERS.schema, ("a",), (model.Reference("b", "two", "b"),))
    two = model.Table("two", model.USERS.schema, ("b",), (model.Reference("a", "one", "a"),))
    with pytest.raises(ValueError):
        model.load_order([one, two])


def test_times_and_dates_travel_as_text():
    wire = {f.name: f.dataType.simpleString() for f in model.STREAM_EVENTS.wire.fields}
    assert wire["timestamp"] == "string" and wire["user_id"] == "int"
    assert model.USERS.wire["registration_date"].dataType.simpleString() == "string"


def test_references_name_existing_tables_and_keys():
    for t in model.TABLES.values():
        for ref in t.references:
            assert ref.key in model.TABLES[ref.parent].columns
            assert ref.column in t.columns
