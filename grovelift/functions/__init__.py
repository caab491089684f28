from grovelift.functions.ids import canonical_id, canonical_value
from grovelift.functions.text import bind_tokens, qualified_name, quoted

__all__ = ["bind_tokens", "canonical_id", "canonical_value", "qualified_name", "quoted"]
