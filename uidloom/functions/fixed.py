"""Names and words that must equal those of the source tables."""

KEY_COLUMNS = ("ID", "ANONYMOUS_ID", "USER_ID", "EMAIL")
TIMESTAMP_COLUMNS = ("RECEIVED_AT", "SENT_AT", "TIMESTAMP")
RID_COLUMN = "RID"
TRACKED_COLUMNS = (*KEY_COLUMNS, *TIMESTAMP_COLUMNS, RID_COLUMN)

TABLE_NAME_PARTS = ("IDENTIFIES",)
IGNORED_NAME_PARTS = ("DEV", "STAGING", "IDENTIFIES_METADATA")
PUBLIC_PREFIX = "LOOKER_SOURCE.PUBLIC."
METADATA_SCHEMA = "IDENTIFIES_METADATA"

UUID_COLUMNS = ("user_id_uuid", "username_uuid", "persona_uuid", "rid_uuid")
VALID_UUID = "valid_uuid"

TRUE_WORDS = ("yes", "true", "t", "1")
