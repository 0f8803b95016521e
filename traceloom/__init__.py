"""traceloom: Spark jobs over conversations, tool calls, evaluation evidence and text corpora."""
