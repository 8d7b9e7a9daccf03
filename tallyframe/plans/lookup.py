"""Point lookups and searches over people, licences and check-ins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report_lookup(reports: DataFrame, day: date, city: str, kind: str) -> DataFrame:
    """Reports of one day, city and kind; ``day`` is a date, which the scan can use."""
    return reports.filter((F.col("day") == F.lit(day)) & (F.col("city") == city) & (F.col("type") == kind)).drop("day")


def last_house(people: DataFrame, street: str) -> DataFrame:
    """Person with the highest house number of the street; the smallest id among equals."""
    return people.filter(F.col("address_street_name") == street).orderBy(F.col("address_number").desc(), "id").limit(1)


def name_search(people: DataFrame, street: str, part: str) -> DataFrame:
    return people.filter((F.col("address_street_name") == street) & F.lower("name").contains(part.lower()))


def by_ids(interviews: DataFrame, ids: list[int]) -> DataFrame:
    return interviews.filter(F.col("person_id").isin(*ids))


def by_text_id(interviews: DataFrame, text_id: str) -> DataFrame:
    """The id comes as text; it is cast, not the column, so that the scan can use it."""
    return interviews.filter(F.col("person_id") == F.lit(text_id).cast("long"))


def member_plate_match(
    members: DataFrame, people: DataFrame, licences: DataFrame, id_prefix: str, status: str, plate_part: str
) -> DataFrame:
    """Members by start of the member id and status whose plate contains a text; case does not matter."""
    found = members.filter(F.col("id").ilike(f"{id_prefix}%") & (F.col("membership_status") == status)).select("person_id")
    cars = licences.filter(F.col("plate_number").ilike(f"%{plate_part}%")).select(F.col("id").alias("license_id"))
    return (
        found.join(people, F.col("person_id") == people["id"]).join(cars, "license_id").select("name", "id")
    )


def attendance_profile(
    checkins: DataFrame,
    people: DataFrame,
    licences: DataFrame,
    event: str,
    month: int,
    times: int,
    make: str,
    model: str,
    gender: str,
    hair: str,
    height: tuple[int, int],
) -> DataFrame:
    """People with a given look and car who came to an event exactly ``times`` in a month (yyyymm).

    Check-ins are counted before the joins; the month is a range of dates.
    """
    first = F.make_date(F.lit(month // 100), F.lit(month % 100), F.lit(1))
    in_month = (F.col("day") >= first) & (F.col("day") < F.add_months(first, 1))
    counts = (
        checkins.filter((F.col("event_name") == event) & in_month)
        .groupBy("person_id")
        .agg(F.count("person_id").alias("attendances"))
        .filter(F.col("attendances") == times)
    )
    wanted = licences.filter(
        (F.col("car_make") == make)
        & (F.col("car_model") == model)
        & (F.col("gender") == gender)
        & (F.col("hair_color") == hair)
        & F.col("height").between(*height)
    ).withColumnRenamed("id", "license_id")
    who = people.select(F.col("id").alias("person_id"), "name", "license_id")
    return counts.join(who, "person_id").join(wanted, "license_id").select(
        "person_id", "attendances", "name", "hair_color", "gender", "height", "car_make", "car_model"
    )
