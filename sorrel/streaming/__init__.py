"""Row contracts and counts over streams."""
