-- Flow statistics by flow, status and day, for days up to :partition_date.
SELECT flow_name, status, to_date(datetime) AS day, count(*) AS n
FROM flow_log
WHERE to_date(datetime) <= :partition_date
GROUP BY flow_name, status, to_date(datetime)
