"""Names, limits and sentinels that a change stream's format prescribes."""

# Envelope field names, as they appear in the JSON payload.
EVENT_ID = "eventID"
EVENT_NAME = "eventName"
EVENT_VERSION = "eventVersion"
EVENT_SOURCE = "eventSource"
REGION = "awsRegion"
BODY = "dynamodb"

# Body field names.
SIZE_BYTES = "SizeBytes"
SEQUENCE_NUMBER = "SequenceNumber"
VIEW_TYPE = "StreamViewType"
KEYS = "Keys"
NEW_IMAGE = "NewImage"
OLD_IMAGE = "OldImage"
CREATION_TIME = "ApproximateCreationDateTime"

# Attribute type tags.
ATTRIBUTE_TYPES = ("S", "N", "B", "NULL", "BOOL", "SS", "NS", "BS", "M", "L")

# Operations.
INSERT = "INSERT"
MODIFY = "MODIFY"
REMOVE = "REMOVE"

# Checkpoint sentinels.
TRIM_HORIZON = "TRIM_HORIZON"
LATEST = "LATEST"
AT_TIMESTAMP = "AT_TIMESTAMP"
SHARD_END = "SHARD_END"

# Shard catalog constants.
SYNTHETIC_END = "9223372036854775807"
MIN_HASH_KEY = "0"
MAX_HASH_KEY = "340282366920938463463374607431768211455"
SHARD_ID_SEPARATOR = "-"

# Limits.
MAX_RECORDS_PER_READ = 1000
CHECKPOINT_EVERY = 10
PROGRESS_RETENTION = "6 hours"
RETENTION_HOURS = 24

# Stream summary constants.
STREAM_MODE = "PROVISIONED"
ENCRYPTION_TYPE = "NONE"
CONSUMER_COUNT = 0

# Stream status translation.
STREAM_STATUS = {
    "ENABLED": "ACTIVE",
    "ENABLING": "CREATING",
    "DISABLED": "ACTIVE",
    "DISABLING": "ACTIVE",
}
DISABLED = "DISABLED"
READABLE_STATUS = ("ACTIVE", "UPDATING")
