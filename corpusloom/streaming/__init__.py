"""Package part: streaming."""
