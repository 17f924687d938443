"""Lookup tables against values written out here."""

from tailwake import constants as K


def test_capacities():
    seats = {"A20N": 180, "A21N": 220, "A319": 150, "B752": 200, "B763": 290, "B77W": 396, "CRJ9": 90, "E190": 100}
    assert {model: K.AIRCRAFT_CAPACITY[model] for model in seats} == seats
    assert len(K.AIRCRAFT_CAPACITY) == 25 and K.DEFAULT_CAPACITY == 180


def test_hubs():
    some = {"KUL", "CGK", "PNH", "HKG", "TPE", "DXB", "IST", "LHR", "MUC", "JFK", "SEA"}
    assert some <= set(K.HUB_AIRPORTS) and len(set(K.HUB_AIRPORTS)) == 34


def test_names_and_places():
    names = {"GIA": "Garuda Indonesia", "LNI": "Lion Air", "BTK": "Batik Air"}
    assert {code: K.AIRLINE_NAMES[code] for code in names} == names and len(K.AIRLINE_NAMES) == 104
    places = {row[0]: row for row in K.AIRPORTS}
    assert len(places) == 19
    assert places["CGK"][1:3] == ("WIII", "Soekarno-Hatta Int. Airport")
    assert places["SUB"][4:] == (-7.3798, 112.7836)
