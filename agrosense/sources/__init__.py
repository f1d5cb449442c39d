"""Channel, file, bus and table readers; the events -> sensor-lines test adapter."""
