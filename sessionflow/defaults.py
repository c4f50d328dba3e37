"""Thresholds, formats and zones of the telemetry feeds."""

TRIP_GAP_MS = 30_000
TRANSFER_GAP_MS = 30_000
STATE_TIMEOUT_MS = 10_000
WATERMARK = "5 minutes"
SPAN_WATERMARK = "1 hour"
SPAN_WATERMARK_MS = 3_600_000
SPAN_TIMEOUT_MS = 1_800_000
COLLECT_TIMEOUT_MS = 30_000
WALL_CLOCK_FORMAT = "yyyy-MM-dd HH:mm:ss"
WALL_CLOCK_ZONE = "GMT+8"
STATION_TRIGGER = "5 seconds"
TRIP_STATUS_TRIGGER = "10 seconds"
SOCKET_HOST = "localhost"
SOCKET_PORT = 3333
KAFKA_SERVERS = "localhost:9092"
KAFKA_TOPIC = "test"
KAFKA_STARTING_OFFSETS = "latest"
KAFKA_MAX_OFFSETS_PER_TRIGGER = 40_000
KAFKA_FAIL_ON_DATA_LOSS = False
KAFKA_MAX_REQUEST_SIZE = 4_194_304
STATION_QUERY_NAME = "iot-status-query"
SPAN_QUERY_NAME = "events"
