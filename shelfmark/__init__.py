"""Set-based Spark jobs for curating a catalogue of makers and products."""
