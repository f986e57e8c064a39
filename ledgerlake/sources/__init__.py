"""Sources: raw envelopes, seeds, declared tables."""
from .raw import (ENVELOPE, RAW_ENTITIES, bronze, drop_failed, envelope_from_text, extract_key, join_manifest,
                  read_raw, registered_files, resolve_block_number, unreadable)
from .seed import Catalog, read_seed
