"""Plans: map elements to records, vetting of candidates, walks over links."""
