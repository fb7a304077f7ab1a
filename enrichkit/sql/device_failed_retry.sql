-- Newest dead letter of each reference since a day, where that one is a failure.
SELECT newest.*
FROM (
  SELECT min_by(struct(*), struct(-unix_micros(CAST(bq_updated_time AS timestamp)), uuid)) AS newest
  FROM device_dead_letter
  WHERE partition_date >= :from_date
  GROUP BY reference_id
)
WHERE NOT startswith(newest.api_status, '2') AND newest.api_status <> 'success'
ORDER BY newest.bq_updated_time, newest.uuid
