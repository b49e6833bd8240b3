"""Whole sample rows that tests change field by field."""

from __future__ import annotations


def record(id, title="A title", **changes):
    """A full raw record; keyword arguments replace fields."""
    people = changes.pop("people", ["Ann Ash", "Bo Birch"])
    crew = changes.pop("crew", [("Cy Cedar", "Director"), ("Di Date", "Writer")])
    base = {
        "id": id, "title": title, "tagline": "t", "overview": "o", "status": "Released",
        "release_date": "2011-05-06", "original_language": "en", "poster_path": "/p.jpg",
        "genres": [{"id": 1, "name": "Comedy"}, {"id": 2, "name": "Science Fiction"}],
        "production_countries": [{"iso_3166_1": "FR", "name": "France"}],
        "production_companies": [{"name": "Lantern"}, {"name": "Mill"}],
        "spoken_languages": [{"iso_639_1": "fr", "name": "French"}],
        "belongs_to_collection": {"id": 9, "name": "Saga"},
        "budget": 20_000_000, "revenue": 50_000_000, "runtime": 100, "vote_count": 40,
        "vote_average": 6.5, "popularity": 3.5,
        "credits": {
            "cast": [{"name": n, "order": i, "character": "x"} for i, n in enumerate(people)],
            "crew": [{"name": n, "job": j, "department": "d"} for n, j in crew],
        },
    }
    return base | changes


def event(**changes):
    """A valid raw event; keyword arguments replace fields."""
    return {
        "event_id": "0a1b2c3d-0000-4000-8000-000000000001", "event_time": "2024-03-05T10:20:30.123456+00:00",
        "user_id": "17", "session_id": "0a1b2c3d-0000-4000-8000-0000000000ff", "event_type": "view",
        "product_id": "P7", "product_name": "Lamp", "category": "Home", "price": "12.50", "quantity": "3",
        "_corrupt_record": None,
    } | changes
