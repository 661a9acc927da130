"""Invented F1-shaped landed pages for two seasons (edge cases of FIXTURES §4)."""

from __future__ import annotations

from conftest import land_page

RACES = ["RaceTable", "Races"]
DRIVERS = ["DriverTable", "Drivers"]


def circuit(cid, name, country, lat, long, locality="x"):
    loc = {"locality": locality, "lat": str(lat), "long": str(long)}
    if country is not None:
        loc["country"] = country
    return {"circuitId": cid, "circuitName": name, "Location": loc}


def race(season, rnd, date, circ, **extra):
    return {
        "season": season,
        "round": str(rnd),
        "date": date,
        "time": "15:00:00Z",
        "raceName": f"GP {season}-{rnd}",
        "url": f"http://example.invalid/{season}/{rnd}",
        "Circuit": circ,
        **extra,
    }


def result(driver, team, pos, grid, points, laps="50", timed=True, **extra):
    rec = {
        "number": extra.pop("number", "1"),
        "position": pos,
        "points": str(points),
        "grid": str(grid),
        "laps": laps,
        "status": "Finished" if pos.isdigit() else "Retired",
        "Driver": {"driverId": driver},
        "Constructor": {"constructorId": team.lower().replace(" ", "_"), "name": team},
    }
    if timed:
        rec["Time"] = {"millis": "5400000"}
        rec["FastestLap"] = {"rank": "3", "lap": "40"}
    rec.update(extra)
    return rec


def sprint(driver, team, pos, grid, points):
    return {
        "position": pos,
        "points": str(points),
        "grid": str(grid),
        "status": "Finished",
        "Driver": {"driverId": driver},
        "Constructor": {"constructorId": team.lower(), "name": team},
    }


def parent(season, rnd, key, rows):
    out = {"season": season, "round": str(rnd), "raceName": f"GP {season}-{rnd}"}
    if rows is not None:
        out[key] = rows
    return out


def driver(did, given, family, code, number, dob, nat):
    rec = {"driverId": did, "givenName": given, "code": code, "dateOfBirth": dob, "nationality": nat,
           "url": f"http://example.invalid/{did}"}
    if family is not None:
        rec["familyName"] = family
    if number is not None:
        rec["permanentNumber"] = number
    return rec


BAHRAIN = circuit("bahrain", "Bahrain International Circuit", "Bahrain", 26.0325, 50.5106)
MIAMI = circuit("miami", "Miami International Autodrome", "USA", 25.9581, -80.2389)
VEGAS = circuit("vegas", "Las Vegas Strip Circuit", "USA", 36.1147, -115.173)
RING = circuit("red_bull_ring", "Red Bull Ring", "Austria", 47.2197, 14.7647)


def land_f1(root: str, grid_text: str = "1") -> None:
    """Land pages for 2023 and 2024 under ``root``."""
    ds = "f1"
    # races: 2023 two races at one circuit; 2024 two in Bahrain (one circuit), two in the USA
    land_page(root, ds, "races", "2023", 0, 2, RACES, [
        race("2023", 1, "2023-07-02", RING),
        race("2023", 2, "2023-07-09", RING),
    ])
    land_page(root, ds, "races", "2024", 0, 4, RACES, [
        race("2024", 1, "2024-03-02", BAHRAIN),
        race("2024", 2, "2024-05-05", MIAMI, SprintQualifying={"date": "2024-05-03", "time": "20:30:00Z"}),
        race("2024", 3, "2024-11-23", VEGAS),
        race("2024", 4, "2024-12-08", BAHRAIN),
    ])
    # drivers
    land_page(root, ds, "drivers", "2023", 0, 3, DRIVERS, [
        driver("ver", "Max", "Verstappen", "VER", "33", "1997-09-30", "Dutch"),
        driver("ham", "Lewis", "Hamilton", "HAM", "", "1985-01-07", "British"),
        driver("spr", "Sprint", "Only", "SPR", "99", "1990-01-01", "Finnish"),
    ])
    land_page(root, ds, "drivers", "2024", 0, 3, DRIVERS, [
        driver("ver", "Max", "Verstappen", "VER", "33", "1997-09-30", "Dutch"),
        driver("ham", "Lewis", "Hamilton", "HAM", "44", "1985-01-07", "British"),
        driver("nob", "No", None, "NOB", None, "2000-02-02", "Japanese"),
    ])
    # results 2023
    land_page(root, ds, "results", "2023", 0, 4, RACES, [
        parent("2023", 1, "Results", [
            result("ver", "Red Bull", "1", grid_text, 25),
            result("ham", "Mercedes", "2", 3, 18),
        ]),
        parent("2023", 2, "Results", [
            result("ver", "Red Bull", "1", 2, 25),
            result("ham", "Mercedes", "R", 1, 0),
        ]),
    ])
    # results 2024: round 1 split over two pages; rounds 5 and 6 without results
    land_page(root, ds, "results", "2024", 0, 45, RACES, [
        parent("2024", 1, "Results", [
            result("ver", "Red Bull", "1", 1, 25),
            result("ham", "Mercedes", "3", 2, 15),
        ]),
    ])
    land_page(root, ds, "results", "2024", 30, 45, RACES, [
        parent("2024", 1, "Results", [
            result("ghost", "Haas", "R", 20, 0, timed=False),
        ]),
        parent("2024", 2, "Results", [
            result("ver", "Red Bull", "2", 1, 18, season="1999"),
            result("ham", "Mercedes", "", 3, 0),
            result("nob", "Williams", "99999999999", 4, 0),
        ]),
        parent("2024", 3, "Results", [
            result("ver", "Red Bull", "1", 2, 25),
            result("ham", "Ferrari", "4", 1, 12),
        ]),
        parent("2024", 4, "Results", [
            result("ver", "Alpha", "5", 3, 10),
            result("ham", "Ferrari", "6", 5, 8),
        ]),
        parent("2024", 5, "Results", None),
        parent("2024", 6, "Results", []),
    ])
    # sprints: none in 2023; 2024 round 2 with a sprint-only driver
    land_page(root, ds, "sprint", "2023", 0, 0, RACES, [parent("2023", 1, "SprintResults", None)])
    land_page(root, ds, "sprint", "2024", 0, 3, RACES, [
        parent("2024", 2, "SprintResults", [
            sprint("ver", "Red Bull", "1", 1, 8),
            sprint("ham", "Mercedes", "2", 2, 7),
            sprint("spr", "Haas", "3", 3, 6),
        ]),
    ])
