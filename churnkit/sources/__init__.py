"""Reading, writing, aligning and synchronising tables."""
