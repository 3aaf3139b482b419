"""File, stream, model and result stores."""
