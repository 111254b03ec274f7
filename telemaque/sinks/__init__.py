"""Where rows go in batch. For streams see :mod:`telemaque.streaming`."""
