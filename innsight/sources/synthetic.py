"""Seeded synthetic facts that keep foreign keys valid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.operators.ordered import global_row_number


def synthetic_bookings(like: DataFrame, properties: DataFrame, users: DataFrame, seed: int, first_day: str = "2000-01-01", days: int = 365) -> DataFrame:
    """One made-up booking per row of ``like``, referring to existing users and properties.

    Every value is a hash of the row's id and the seed, so the result does not depend
    on partitioning. Dimension keys are numbered once and picked by number with a
    plain equi-join; nothing is drawn on the driver.
    """
    def pick(salt: int, size):
        return F.pmod(F.xxhash64(F.col("booking_id"), F.lit(seed), F.lit(salt)), size)

    listed = global_row_number(properties.select("property_id", "base_price"), ["property_id"], "p_no")
    people = global_row_number(users.select("user_id"), ["user_id"], "u_no")
    listings = listed.agg(F.count(F.lit(1))).scalar()
    persons = people.agg(F.count(F.lit(1))).scalar()
    seeds = like.select((F.col("booking_id") + F.lit(10_000_000_000)).alias("booking_id"))
    drawn = seeds.withColumns({"p_no": pick(1, listings) + 1, "u_no": pick(2, persons) + 1})
    arrival = F.date_add(F.lit(first_day).cast("date"), pick(3, F.lit(days)).cast("int"))
    nights = (pick(4, F.lit(14)) + 1).cast("int")
    return (
        drawn.join(listed, "p_no")
        .join(people, "u_no")
        .select(
            "booking_id", "user_id", "property_id", arrival.alias("check_in_date"), F.date_add(arrival, nights).alias("check_out_date"),
            (pick(5, F.lit(6)) + 1).cast("int").alias("guests_count"),
            (F.col("base_price") * nights).cast("decimal(18,2)").alias("total_amount"),
            F.when(pick(6, F.lit(20)) == 0, "cancelled").otherwise("confirmed").alias("status"),
        )
    )
