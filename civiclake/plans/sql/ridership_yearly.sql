/*---
name: ridership_yearly
description: Ridership of each mode in a year; a folder per year.
deps: [daily_ridership]
group: transportation
partitions: {type: yearly, start: "2018", end_offset: 1}
tags: {domain: transportation, stage: analytics}
---*/
WITH days AS (
    SELECT mode, date, count AS riders
    FROM daily_ridership
    WHERE date BETWEEN {{partition_start}} AND date_sub({{partition_end}}, 1)
)
SELECT
    extract(YEAR FROM first_date) AS year, mode, days_reported,
    round(riders, 0) AS total_riders, round(riders / nullif(readings, 0), 1) AS avg_daily_riders, round(peak, 0) AS peak_daily_riders,
    first_date, last_date
FROM (
    SELECT mode, count(*) AS days_reported, count(riders) AS readings, sum(riders) AS riders, max(riders) AS peak,
           min(date) AS first_date, max(date) AS last_date
    FROM days GROUP BY mode
)
